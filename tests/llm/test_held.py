"""Workers hold the tables of one operator at a time."""

from catalog_marts.llm.held import held, release


def test_one_operator_at_a_time():
    built = []
    make = lambda name: lambda: built.append(name) or name
    assert held(("a", 1), make("a")) == held(("a", 1), make("a again")) == "a"
    assert held(("b", 1), make("b")) == "b" and held(("a", 1), make("a2")) == "a2"
    release()
    assert held(("a", 1), make("a3")) == "a3" and built == ["a", "b", "a2", "a3"]
    release()
