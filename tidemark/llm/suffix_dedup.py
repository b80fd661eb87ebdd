"""Removal of repeated 400-byte strings by bucket-pointer refinement of suffixes.

A suffix's bucket names its first bytes. Buckets of 8-byte grams are the bytes themselves; the bucket of
a longer string is named by the bucket at its place and the bucket at a later offset, both already
refined, so 8 becomes 16, 32, 64, 128 and in the end 400 with no string compared. Names are 64-bit
mixtures of the two, so that they mean the same in every task. Only suffixes that can still be equal to
another are carried on:

1. Anchors. Of the 128-byte buckets in a 400-byte string the least is its anchor, so equal strings have
   equal anchors at equal offsets. A run is the strings around one anchor. Every text gives its
   runs: bucket of the anchor, bucket of the whole run, places. Texts are addressed by their SHA-256.
2. An anchor bucket with one member is done: nothing there repeats. Of the others, a run whose whole
   bucket is shared repeats in all its strings.
3. Runs that share an anchor, but not the whole, are refined in blocks of sixteen strings. Where the core
   that the strings of a block have in common is not shared, none repeats; where the hull around them is
   shared, all do. Only blocks in between, at the ends of a repetition, get the buckets of their
   strings, of 400 bytes; shared ones repeat.
4. Repeating strings are merged to spans, cut out, and what is left is digested.

Many passages of over 50 words are shorter than 400 bytes, so nothing of them is removed; texts that share one
with another row are marked. The same steps run over words in place of bytes (the gaps between words do not
count): buckets of single words become those of 16 words, among which the anchors are, and of 51. A run whose
whole is shared marks its texts; runs that share only the anchor give the buckets of their 51-word strings, if one
of their texts is not marked yet.

All groups are counts or extremes, combined before the shuffle; no group is gathered. Texts move by
shuffle only when the runs to refine, or the spans to cut, have too many bytes to broadcast. Rows of a text
that makes up more than a thousandth of the table (fewer than a thousand such texts) stay where they are.

Null and empty texts have 0 bytes and no spans. Rows with equal texts of 400 bytes or more lose all; of over 50
words, they share a passage.
Rows without doc_id and repeated ids are treated like any other row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_NUMBERS, documents, kept, shrink, shrink_lists
from tidemark.llm.textops import hashes_in_order, mix, text_chunks, text_column, word_hashes, words_of

LENGTH = 400
GRAM = 128
Q = 8
BLOCK = 16  # neighbouring strings that are tested together
HALF = 256  # bytes of the last bucket that all places get
WORDS = 51  # of the shortest passage that marks a text
WORD_GRAM = 16
_POSITION_BITS = 30
_CROWD = 1000  # a text with more than this part of all rows is a hot key
_U = np.uint64
_PAIR = _U(0x9DDFEA08EB382D69)


def first_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the q-gram at every place: its eight bytes as a number."""
    if len(data) < Q:
        return np.zeros(0, dtype=np.uint64)
    padded = np.lib.stride_tricks.sliding_window_view(data, Q)
    return mix(np.ascontiguousarray(padded).view("<u8").ravel() ^ _U(0x8EBC6AF09C88C6E3))


def refined(buckets: np.ndarray, have: int, want: int) -> np.ndarray:
    """Buckets of strings of ``want`` bytes from those of ``have`` (< want <= 2 have) bytes.

    The bucket at a place and the one ``want - have`` later name the longer string.
    """
    gap = want - have
    with np.errstate(over="ignore"):
        return mix(buckets[:-gap] * _PAIR + buckets[gap:]) if len(buckets) > gap else buckets[:0]


def buckets_of(data: np.ndarray, length: int) -> np.ndarray:
    out, have = first_buckets(data), Q
    while have < length:
        want = min(2 * have, length)
        out, have = refined(out, have, want), want
    return out


def _anchored(grams: np.ndarray, gram: int, length: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor place, first window, last window, anchor bucket) of every run of windows with one anchor.

    A window's anchor is the place in it whose gram's bucket is least (the first of equals).
    """
    none = np.zeros(0, np.int64)
    spread = length - gram + 1
    if offsets[-1] < length:
        return none, none, none, none, none.astype(np.uint64)
    packed = (grams >> _U(_POSITION_BITS) << _U(_POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)
    low, have = packed, 1
    while have < spread:
        step = min(have, spread - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    anchor = (low & _U((1 << _POSITION_BITS) - 1)).astype(np.int64)
    ends = offsets[1:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    start = np.arange(len(anchor))
    valid = start + length <= ends[row]
    start, anchor, row = start[valid], anchor[valid], row[valid]
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    stop = np.concatenate((begin[1:], [len(start)])) - 1
    return row[begin], anchor[begin], start[begin], start[stop], grams[anchor[begin]]


def anchors_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_anchored` for strings of ``LENGTH`` bytes."""
    return _anchored(buckets_of(data, GRAM), GRAM, LENGTH, offsets)


def _word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row's first word among all words, and the bucket of the ``WORD_GRAM`` words at every word."""
    first, last, row = words_of(data, offsets)
    out, have = hashes_in_order(data, first, last), 1
    while have < WORD_GRAM:
        out, have = refined(out, have, 2 * have), 2 * have
    return np.searchsorted(row, np.arange(len(offsets))), out


def _passage_names(grams: np.ndarray) -> np.ndarray:
    """The bucket of the ``WORDS`` words at every word."""
    return refined(refined(grams, WORD_GRAM, 2 * WORD_GRAM), 2 * WORD_GRAM, WORDS)


def passages_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words per row; row, first passage, last passage, anchor bucket, whole bucket) of the runs of ``WORDS`` words."""
    begin, grams = _word_grams(data, offsets)
    row, _, first, last, names = _anchored(grams, WORD_GRAM, WORDS, begin)
    passages = _passage_names(grams)
    # The first and the last passage of a run overlap, so that they hold all of its words.
    with np.errstate(over="ignore"):
        whole = mix(passages[first] * _PAIR + passages[last] + (last - first).astype(np.uint64))
    return np.diff(begin), row, first - begin[row], last - begin[row], names, whole


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _encoded(column: pa.Array) -> Iterator[bytes]:
    for text in text_column(column):
        yield text.as_buffer().to_pybytes() if text.as_buffer() is not None else b""


_SURVEY = (
    "doc_id long, sha binary, n_bytes long, anchor array<long>, whole array<long>, at array<int>, first array<int>, last array<int>, "
    "n_words long, word_anchor array<long>, word_whole array<long>, word_first array<int>, word_last array<int>"
)


_SURVEY_NAMES = [column.split()[0] for column in _SURVEY.split(", ")]


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, size and runs of every text, by bytes and by words."""
    for batch in batches:
        column = batch.column("text")
        for lo, hi, data, offsets in text_chunks(column):
            row, at, first, last, names = anchors_of(data, offsets)
            whole = mix(word_hashes(data, first, last + LENGTH) ^ names) if len(at) else names
            base = offsets[row]
            cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
            lists = [_signed(names), _signed(whole), *[pa.array((x - base).astype(np.int32)) for x in (at, first, last)]]
            sha = [hashlib.sha256(data[offsets[k] : offsets[k + 1]].tobytes()).digest() for k in range(hi - lo)]
            arrays = [batch.column("doc_id").slice(lo, hi - lo), pa.array(sha, pa.binary()), pa.array(np.diff(offsets))]
            arrays += [pa.ListArray.from_arrays(cut, x) for x in lists]
            n_words, row, first, last, names, whole = passages_of(data, offsets)
            cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
            lists = [_signed(names), _signed(whole), *[pa.array(x.astype(np.int32)) for x in (first, last)]]
            arrays += [pa.array(n_words.astype(np.int64)), *[pa.ListArray.from_arrays(cut, x) for x in lists]]
            yield pa.RecordBatch.from_arrays(arrays, _SURVEY_NAMES)


def _at(buckets: np.ndarray, have: int, places: np.ndarray, want: int) -> np.ndarray:
    """Buckets of strings of ``want`` bytes at some places alone, from those of ``have`` bytes."""
    with np.errstate(over="ignore"):
        return mix(buckets[places] * _PAIR + buckets[places + want - have])


def _listed(batch: pa.RecordBatch, lo: int, hi: int, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The struct fields listed for rows lo..hi-1, flat, places shifted to the chunk; with ``row``.

    ``offsets`` are the rows' starts in the unit of the places, bytes or words.
    """
    lists = batch.column("runs").slice(lo, hi - lo)
    counts = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(hi - lo), counts)
    flat = lists.flatten()
    out = {f.name: flat.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(flat.type)}
    for name in out.keys() & {"at", "first", "last"}:
        out[name] = out[name].astype(np.int64) + offsets[row]
    out["row"] = row
    return out


def _half(data: np.ndarray) -> np.ndarray:
    return buckets_of(data, HALF)


_BLOCKS = "whole long, resolved boolean, block int, core long, hull long"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block of the runs listed for a text: buckets of its core and of its hull.

    A hull that would pass the text's ends is named after its run alone, and so is shared with none.
    """
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            runs = _listed(batch, lo, hi, offsets)
            if not len(runs["at"]):
                continue
            half = _half(data)
            least = (runs["at"] - runs["last"]) // BLOCK
            many = (runs["at"] - runs["first"]) // BLOCK - least + 1
            run = np.repeat(np.arange(len(many)), many)
            block = least[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            inner = runs["at"][run] - BLOCK * block  # the block's last string starts here
            outer = inner - (BLOCK - 1)  # and its first here
            with np.errstate(over="ignore"):
                shift = block.astype(np.uint64)
                core = mix(_at(half, HALF, inner, LENGTH - BLOCK + 1) + shift)
                whole = runs["whole"][run]
                hull = mix(whole.view(np.uint64) * _PAIR + shift)
                inside = (outer >= offsets[runs["row"][run]]) & (inner + LENGTH <= offsets[runs["row"][run] + 1])
                hull[inside] = mix(_at(half, HALF, outer[inside], LENGTH + BLOCK - 1) + shift[inside])
            arrays = [pa.array(whole), pa.array(runs["resolved"][run]), pa.array(block.astype(np.int32)), _signed(core), _signed(hull)]
            yield pa.RecordBatch.from_arrays(arrays, ["whole", "resolved", "block", "core", "hull"])


_STRINGS = "whole long, start int, core long, string long"


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per string of the blocks listed for a text."""
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            runs = _listed(batch, lo, hi, offsets)
            if not len(runs["at"]):
                continue
            half = _half(data)
            inner = runs["at"] - BLOCK * runs["block"]
            begin = np.maximum(runs["first"], inner - (BLOCK - 1))
            many = np.minimum(runs["last"], inner) - begin + 1
            run = np.repeat(np.arange(len(many)), many)
            start = begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            own = (start - offsets[runs["row"][run]]).astype(np.int32)
            core = runs["core"][run]
            arrays = [pa.array(runs["whole"][run]), pa.array(own), pa.array(core), _signed(_at(half, HALF, start, LENGTH))]
            yield pa.RecordBatch.from_arrays(arrays, ["whole", "start", "core", "string"])


_PASSAGES = "text long, passage long"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per passage of ``WORDS`` words of the runs listed for a text."""
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            begin, grams = _word_grams(data, offsets)
            runs = _listed(batch, lo, hi, begin)
            if not len(runs["first"]):
                continue
            many = runs["last"] - runs["first"] + 1
            run = np.repeat(np.arange(len(many)), many)
            start = runs["first"][run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays([pa.array(runs["text"][run]), _signed(_passage_names(grams)[start])], ["text", "passage"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept_sha = []
        for raw, spans in zip(_encoded(batch.column("text")), batch.column("spans"), strict=True):
            rest, end = hashlib.sha256(), 0
            for span in sorted(spans.as_py(), key=lambda x: x["lo"]):
                rest.update(raw[end : span["lo"]])
                end = span["hi"]
            rest.update(raw[end:])
            kept_sha.append(rest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("sha"), pa.array(kept_sha)], ["sha", "kept_sha256"])


def _texts(docs: DataFrame) -> DataFrame:
    text = documents(docs).select("text")
    return text.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), "text")


def _of_texts(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """text, runs: the texts that ``listed`` (sha, run) names, each with all its runs."""
    wanted = kept(listed.groupBy(F.col("sha").alias("wanted")).agg(F.collect_list("run").alias("runs")), "wanted")
    return _texts(docs).join(shrink_lists(wanted, "runs"), F.col("sha") == F.col("wanted")).select("text", "runs")


def repeated_spans(docs: DataFrame, survey: DataFrame) -> DataFrame:
    """(sha, lo, hi): merged spans of bytes to remove."""
    live = survey.select(F.explode("anchor").alias("anchor")).groupBy("anchor").count()
    live = kept(live.where("count > 1").select(F.col("anchor").alias("name")), "live")
    runs = survey.select("sha", F.explode(F.arrays_zip("anchor", "whole", "at", "first", "last")).alias("r")).select("sha", "r.*")
    runs = kept(runs.join(shrink(live, live.count(), BROADCAST_NUMBERS), F.col("anchor") == F.col("name")).drop("name"), "runs")
    wholes = kept(
        runs.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("sha", "at", "first", "last")).alias("r")).select("anchor", "whole", "n", "r.*"),
        "wholes",
    )
    crowded = wholes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(F.col("anchor").alias("name"))
    crowded = kept(crowded, "crowded")  # first, so that the join can split an anchor of very many runs
    places = wholes.join(shrink(crowded, crowded.count(), BROADCAST_NUMBERS), F.col("anchor") == F.col("name"), "left_semi")
    places = kept(places.drop("anchor"), "places")
    run = F.struct("whole", (F.col("n") > 1).alias("resolved"), "at", "first", "last")
    # A text that occurs twice gives its blocks twice: shared means by different runs, not by rows.
    apart = F.min("whole") != F.max("whole")
    blocks = kept(_of_texts(docs, places.select("sha", run.alias("run"))).mapInArrow(_blocks, _BLOCKS), "blocks")
    hulls = kept(
        blocks.groupBy("core", "hull", "block").agg(apart.alias("shared"), F.min("resolved").alias("done"), F.min("whole").alias("least"), F.max("whole").alias("most")),
        "hulls",
    )
    alone = ~F.col("shared") & ~F.col("done")
    cores = hulls.groupBy("core").agg((F.min("least") != F.max("most")).alias("met"), F.max(alone).alias("open")).where("met AND open")
    # One run stands for all that share a hull.
    edge = hulls.join(cores.select("core"), "core", "left_semi").select(F.col("least").alias("whole"), "core", "block")
    edge = edge.join(places, "whole").select("sha", F.struct("whole", "at", "first", "last", "block", "core").alias("run"))
    strings = kept(_of_texts(docs, edge).mapInArrow(_strings, _STRINGS), "strings")
    same = strings.groupBy("core", "string").agg(apart.alias("shared")).where("shared").select("core", "string")
    # A run that occurs once has one text.
    single = kept(places.where("n = 1").select("whole", "sha", "at", "first", "last"), "single")
    few = strings.join(same, ["core", "string"], "left_semi").select("whole", "start").distinct()
    few = few.join(single.select("whole", "sha"), "whole").select("sha", F.col("start").alias("lo"), (F.col("start") + LENGTH).alias("hi"))
    whole_blocks = blocks.where("NOT resolved").join(hulls.where("shared").select("core", "hull", "block"), ["core", "hull", "block"], "left_semi")
    inner = F.col("at") - F.col("block") * BLOCK
    some = whole_blocks.select("whole", "block").distinct().join(single, "whole").select(
        "sha", F.greatest(F.col("first"), inner - (BLOCK - 1)).alias("lo"), (F.least(F.col("last"), inner) + LENGTH).alias("hi")
    )
    many = runs.join(wholes.where("n > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    spans = few.unionByName(some).unionByName(many.select("sha", F.col("first").alias("lo"), (F.col("last") + LENGTH).alias("hi")))
    spans = spans.distinct()
    order = Window.partitionBy("sha").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("begins", F.coalesce((F.col("lo") > reach), F.lit(True)).cast("int"))
    marked = marked.withColumn("span", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("sha", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("span")


def _named_text() -> Column:
    """64 bits of a text's digest."""
    return F.xxhash64("sha").alias("text")


def shared_passages(docs: DataFrame, survey: DataFrame) -> DataFrame:
    """(text): names of the texts that share ``WORDS`` words in a row with a different text."""
    apart = F.min("text") != F.max("text")
    live = survey.select(_named_text(), F.explode("word_anchor").alias("anchor")).groupBy("anchor").agg(apart.alias("met"))
    live = kept(live.where("met").select(F.col("anchor").alias("name")), "word_live")
    runs = survey.select("sha", F.explode(F.arrays_zip("word_anchor", "word_whole", "word_first", "word_last")).alias("r"))
    runs = runs.select("sha", _named_text(), F.col("r.word_anchor").alias("anchor"), F.col("r.word_whole").alias("whole"), F.col("r.word_first").alias("first"), F.col("r.word_last").alias("last"))
    runs = kept(runs.join(shrink(live, live.count(), BROADCAST_NUMBERS), F.col("anchor") == F.col("name")).drop("name"), "word_runs")
    wholes = kept(
        runs.groupBy("anchor", "whole").agg(apart.alias("met"), F.min(F.struct("text", "sha", "first", "last")).alias("r")).select("anchor", "whole", "met", "r.*"),
        "word_wholes",
    )
    met = kept(wholes.where("met").select(F.col("whole").alias("name")).distinct(), "word_met")
    sure = kept(runs.join(shrink(met, met.count(), BROADCAST_NUMBERS), F.col("whole") == F.col("name"), "left_semi").select("text").distinct(), "word_sure")
    # A whole that is not shared has one text.
    marked = shrink(sure.select(F.col("text").alias("name")), sure.count(), BROADCAST_NUMBERS)
    crowded = wholes.where("NOT met").join(marked, F.col("text") == F.col("name"), "left_anti").select(F.col("anchor").alias("name")).distinct()
    crowded = kept(crowded, "word_crowded")
    places = wholes.join(shrink(crowded, crowded.count(), BROADCAST_NUMBERS), F.col("anchor") == F.col("name"), "left_semi")
    passages = kept(_of_texts(docs, places.select("sha", F.struct("text", "first", "last").alias("run"))).mapInArrow(_passages, _PASSAGES), "passages")
    same = passages.groupBy("passage").agg(apart.alias("met")).where("met").select(F.col("passage").alias("name"))
    same = kept(same, "passages_met")
    more = passages.join(shrink(same, same.count(), BROADCAST_NUMBERS), F.col("passage") == F.col("name"), "left_semi").select("text")
    return sure.unionByName(more).distinct()


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, shares_passage: one row per document.

    ``shares_passage``: ``WORDS`` words in a row also stand in another row.
    """
    plain = documents(docs)
    survey = kept(plain.mapInArrow(_survey, _SURVEY), "suffixes")
    copies = kept(survey.groupBy("sha").agg(F.count(F.lit(1)).alias("copies")), "copies")
    spans = repeated_spans(plain, survey)
    spans = kept(
        spans.groupBy("sha").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"), F.sum(F.col("hi") - F.col("lo")).alias("removed"), F.count(F.lit(1)).alias("n_spans")),
        "spans",
    )
    alone = kept(spans.join(copies.where("copies = 1"), "sha", "left_semi").select(F.col("sha").alias("wanted"), "spans"), "partly")
    cut = kept(_texts(plain).join(shrink_lists(alone, "spans"), F.col("sha") == F.col("wanted")).select("sha", "text", "spans").mapInArrow(_cut, "sha binary, kept_sha256 string"), "cut")
    shared = kept(shared_passages(plain, survey).select(F.col("text").alias("name"), F.lit(True).alias("shared")), "shared")
    facts = copies.join(spans.drop("spans"), "sha", "left").join(cut, "sha", "left")
    facts = facts.join(shrink(shared, shared.count(), BROADCAST_NUMBERS), _named_text() == F.col("name"), "left").drop("name")
    rows = survey.select("doc_id", "sha", "n_bytes", "n_words")
    # Fewer than _CROWD texts by their definition. A text that occurs twice has no facts but that.
    hot = kept(copies.where((F.col("copies") > 1) & (F.col("copies") * _CROWD > survey.count())), "hot")
    crowds = rows.join(F.broadcast(hot), "sha")
    others = rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(facts, "sha")
    rows = others.unionByName(crowds, allowMissingColumns=True)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", zero)).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        (((F.col("copies") > 1) & (F.col("n_words") >= WORDS)) | F.coalesce("shared", F.lit(False))).alias("shares_passage"),
    )
