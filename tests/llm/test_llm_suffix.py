import hashlib
import re
from collections import Counter

import numpy as np

from llm_fixtures import as_rows, empty, messy, plain_texts, prose
from tidemark.llm import suffix_dedup, tables
from tidemark.llm.queries import LLM_QUERIES
from tidemark.llm.suffix_dedup import LENGTH, buckets_of, deduplicate

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def strings(raw):
    """Every string of 400 bytes, by a digest, so that those of a long text fit in memory."""
    return [hashlib.blake2b(raw[i : i + LENGTH], digest_size=16).digest() for i in range(len(raw) - LENGTH + 1)]


def expected(rows):
    seen = Counter()
    for _, text in rows:
        seen.update(strings((text or "").encode()))
    out = []
    for doc, text in rows:
        raw, spans = (text or "").encode(), []
        for i, name in enumerate(strings(raw)):
            if seen[name] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + LENGTH
                else:
                    spans.append([i, i + LENGTH])
        rest, end = b"", 0
        for lo, hi in spans:
            rest, end = rest + raw[end:lo], hi
        rest += raw[end:]
        out.append((doc, len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    assert as_rows(deduplicate(docs), *COLUMNS) == expected(rows)


def test_messy_table_equals_brute_force(spark):
    rows = [(d, t) for d, t, _ in plain_texts()]
    check(spark, rows)
    assert deduplicate(messy(spark)).count() == len(rows)
    assert deduplicate(empty(spark)).count() == 0


def test_repeats_at_every_place_and_length(spark):
    """Passages at the start, middle and end of texts, just too short, just long enough, overlapping."""
    base = prose(1, 400)
    rows = []
    for k, (lo, size) in enumerate([(0, 399), (0, 400), (1, 400), (5, 401), (100, 650), (300, 415), (307, 416), (1000, 800), (1100, 800), (1733, 432)]):
        part = base[lo : lo + size]
        rows.append((3 * k, part + " " + prose(50 + k, 80)))
        rows.append((3 * k + 1, prose(80 + k, 60) + part))
        rows.append((3 * k + 2, prose(110 + k, 40) + part + prose(140 + k, 50) + part[:-1]))
    rows += [(1000, base), (1001, base[:1500]), (1002, ("line of text " * 60) + base[2000:2500]), (1003, "ab" * 500), (1004, "ab" * 199)]
    check(spark, rows)


def test_a_text_above_a_megabyte(spark):
    """Passages far apart in one very long text, and one that it shares with a short text."""
    parts = [prose(k, 9000) for k in range(20)]
    parts.insert(15, parts[2][500:1700])
    long = " ".join(parts)
    assert len(long.encode()) > 1 << 20
    check(spark, [(1, long), (2, parts[7][40:900]), (3, prose(77, 100)), (4, None)])


def test_texts_that_make_up_much_of_the_table(spark, monkeypatch):
    """Rows of crowded texts, long, short and empty ones, give what those of rare texts give."""
    long, short = prose(1, 200), prose(2, 20)
    rows = [(k, long) for k in range(40)] + [(100 + k, short) for k in range(40)] + [(200 + k, None) for k in range(30)]
    rows += [(None, long), (7, long), (300, long[:500] + prose(4, 30)), (301, prose(5, 90)), (302, prose(5, 90)), (303, "")]
    for crowd in (1, 4, 1000):  # none, some and all of the repeated texts are crowds
        monkeypatch.setattr(suffix_dedup, "_CROWD", crowd)
        check(spark, rows)


def test_texts_move_where_lists_are_too_long_to_broadcast(spark, monkeypatch):
    base = prose(1, 300)
    rows = [(k, base[50 * k : 50 * k + 700] + prose(20 + k, 40)) for k in range(8)] + [(50, base)]
    monkeypatch.setattr(tables, "BROADCAST_BYTES", -1)
    check(spark, rows)


def test_bucket_names_mean_the_same_everywhere():
    raw = np.frombuffer(prose(3, 300).encode(), dtype=np.uint8)
    names = buckets_of(raw, LENGTH)
    assert len(names) == len(raw) - LENGTH + 1 and len(set(names.tolist())) == len(names)
    assert (buckets_of(raw[100:], LENGTH) == names[100:]).all()
    assert len(buckets_of(raw[: LENGTH - 1], LENGTH)) == 0


def sharing(rows):
    """The rows with 51 words in a row that another row has too."""
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        sets.append({tuple(words[i : i + 51]) for i in range(len(words) - 50)})
    seen = Counter(passage for found in sets for passage in found)
    return sorted([(doc, any(seen[x] > 1 for x in found)) for (doc, _), found in zip(rows, sets, strict=True)], key=repr)


def check_passages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    assert as_rows(deduplicate(docs), "doc_id", "shares_passage") == sharing(rows)


def passage_rows():
    rows = [(d, t) for d, t, _ in plain_texts() if d not in (12, 13)]
    base, twice = prose(200, 400).split(), " ".join(prose(201, 60).split())
    for k, (lo, size) in enumerate([(0, 50), (0, 51), (1, 51), (60, 52), (120, 60), (125, 57), (200, 90), (300, 51), (349, 51)]):
        part = base[lo : lo + size]
        gap = "\n" if k % 2 else " "
        rows.append((100 + 3 * k, gap.join(part) + " " + prose(210 + k, 80)))
        rows.append((101 + 3 * k, prose(230 + k, 60) + "  " + "\t ".join(part)))
        rows.append((102 + 3 * k, prose(250 + k, 51) + " " + " ".join(part[:-1]) + "x"))
    # Within one text alone; many texts around one passage; one word, over and over.
    rows += [(200, twice + " between " + twice), (201, "ab " * 300), (202, "ab " * 51), (203, "ab " * 50), (204, "ab " * 50 + "c")]
    rows += [(300 + k, prose(300 + k, 20) + " " + prose(299, 53) + " " + prose(400 + k, 20)) for k in range(30)]
    return rows


def test_passages_of_over_50_words_equal_brute_force(spark, monkeypatch):
    rows = passage_rows()
    assert {b for _, b in sharing(rows)} == {True, False}
    check_passages(spark, rows)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_NUMBERS", -1)
    monkeypatch.setattr(tables, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(suffix_dedup, "_CROWD", 40)
    check_passages(spark, rows)


def test_query_marks_short_passages_that_repeat_across_documents(spark, tmp_path):
    """60 words of under 400 bytes in two texts: nothing is removed, both are marked, the others are not."""
    passage = " ".join(w[:4] for w in prose(500, 60).split())
    assert len(passage) < 320
    rows = [(1, prose(501, 70) + " " + passage), (2, passage + "\n" + prose(502, 70)), (3, prose(503, 140)), (4, passage[:150]), (5, None)]
    rows += [(6, " ".join([prose(504, 80)] * 2))]  # repeats within itself
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = as_rows(LLM_QUERIES["op5_suffix_dedup"](spark, str(tmp_path)), "doc_id", "n_removed", "holds_repeats")
    whole = len(rows[5][1])
    assert got == [(1, 0, True), (2, 0, True), (3, 0, False), (4, 0, False), (5, 0, False), (6, whole - 1, True)]
