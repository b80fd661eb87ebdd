"""Plans read a table a few times at most: every further reading costs the driver memory, whatever the rows."""

from llm_fixtures import as_rows
from tidemark.llm import components, mixing
from tidemark.llm.tables import kept


def readings(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def watched(monkeypatch, module):
    seen = []

    def watch(df, label):
        seen.append((label, readings(df)))
        return kept(df, label)

    monkeypatch.setattr(module, "kept", watch)
    return seen


def test_mixing_reads_no_table_more_than_three_times(spark, monkeypatch):
    seen = watched(monkeypatch, mixing)
    rows = [(k, "one two three " * (k % 7), ("web", "book", None)[k % 3]) for k in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"))
    seen.append(("result", readings(got)))
    assert max(n for _, n in seen) <= 3, seen
    assert len(as_rows(got)) == 40


def test_a_round_of_components_reads_its_links_four_times(spark, monkeypatch):
    seen = watched(monkeypatch, components)
    links = spark.createDataFrame([(k, k + 1) for k in range(12)], "a BIGINT, b BIGINT")
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {k: 0 for k in range(1, 13)}
    assert max(n for _, n in seen) <= 4, seen
