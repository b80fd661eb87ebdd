"""Benchmark decontamination by canonical templates, with DataFrame functions only.

Words are cut at white space. In a template, numbers, names and units are typed placeholders: a word of
digits or a number written out is <num>, a unit after a number is <unit>, a capitalised word within a sentence is <name>; all
others are lower-cased (A-Z) without the punctuation around them. Each letter of a script written without spaces
is a word. Every run of ``WINDOW`` words of a benchmark item is a window (an item with fewer words is one
window). It is looked up by its raw words, lower-cased, and, if it has at least ``PLAIN`` plain words with
more in them than punctuation, by its template, both with <name> and with the names as words. Items of fewer than ``PLAIN`` words, and items of numbers,
units and punctuation alone, match nothing.

Of each window the longest plain word (of its raw words, where it has no template) is its anchor. Documents are read word by word and joined with
the anchors; only around an anchor are templates made, hashed and joined with the windows, and
compared word by word. Windows of one document and item that lie on one diagonal are then counted: the
pair is a leak when they cover at least ``COVER`` words or the whole item, and its slots are consistent,
i.e. each value of the item always meets the same value in the document. Where some are not, windows equal
to the item's and windows with consistent slots alone must cover ``COVER`` + ``WINDOW`` words. Values that
differ show a re-parameterised question.

A benchmark is small beside the corpus, but not bounded: its tables are broadcast only when counted
small and else joined by shuffle. Null or empty texts match nothing. Repeated items and documents give
one row per pair of ids. Documents without an id are known by their text: equal ones give one row (without
a doc_id), and all go. Items without an id are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_ROWS, LOWER, UPPER, ascii_lower, documents, kept, shrink, without

WINDOW = 8
PLAIN = 4
COVER = 13
KEY = "__tm_document"

# Units that follow a number.
UNITS = (
    "mm cm m km in ft yd mi g kg mg lb oz t l ml cl s sec second seconds min minute minutes h hr hour hours day days"
    " week weeks month months year years mph kmh km/h m/s hz khz mhz ghz w kw mw v a j kj cal kcal n pa bar c f k"
    " usd eur gbp dollar dollars euro euros cent cents percent % degree degrees mile miles meter meters metre metres"
    " inch inches foot feet pound pounds gram grams kilogram kilograms liter liters litre litres"
).split()
# Numbers written out.
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
_TENS = "|".join(w for w in NUMBER_WORDS if w.endswith("ty"))
_NUMBER = rf"(?i)^(?:[0-9]+(?:[.,:/][0-9]+)*%?|{'|'.join(NUMBER_WORDS)}|(?:{_TENS})-(?:one|{'|'.join(NUMBER_WORDS[1:9])}))$"
_SLOT = "^<(num|name|unit|num><unit)>$"
_EDGE = ".,;:!?()[]{}\"'`*_<>|~-/\\“”‘’„«»…¿¡"


# A letter of a script without spaces, with the punctuation behind it.
_UNSPACED = (
    r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
    r"[\u3000-\u3004\u3008-\u3020\uFF01-\uFF0F\uFF1A-\uFF20\u2018-\u201F\u2026!?,.;:\"'()]*+"
)


# Every such letter is in these ranges; a text without any is not searched for scripts.
_FAR_LETTERS = r"[\u0E00-\u1FFF\u2E80-\uFFFF\x{10000}-\x{10FFFF}]"


def _words(text: Column) -> Column:
    spaced = F.when(text.rlike(_FAR_LETTERS), F.regexp_replace(text, _UNSPACED, " $1 ")).otherwise(text)
    return F.array_remove(F.split(spaced, r"[\x20\x09-\x0D]+"), "")


def plain_word(word: Column) -> Column:
    """Lower-cased without punctuation around it; a word of punctuation alone stays."""
    bare = F.btrim(ascii_lower(word), F.lit(_EDGE))
    return F.when(bare == "", ascii_lower(word)).otherwise(bare)


def _key(word: Column) -> Column:
    """What anchors are looked up by: coarser than :func:`plain_word`, and cheap; never null.

    Lower-cased without any of the signs, wherever they stand, so that a whole text can be turned at once.
    """
    return F.coalesce(F.translate(word, UPPER + _EDGE, LOWER), F.lit(""))


def _keys(words: Column) -> Column:
    """The key of every word, in one pass over the text."""
    return F.split(_key(F.array_join(words, " ")), " ")


def _typed(word: Column, before: Column, named: bool) -> Column:
    bare = F.btrim(word, F.lit(_EDGE + "+$€£"))
    attached = r"^[0-9]+(?:[.,][0-9]+)*(?:" + "|".join(u for u in UNITS if u != "%") + ")$"
    low = ascii_lower(bare)
    unit = low.isin(*UNITS) & F.coalesce(F.btrim(before, F.lit(_EDGE + "+$€£")).rlike(_NUMBER), F.lit(False))
    typed = F.when(bare.rlike(_NUMBER), "<num>").when(low.rlike(attached), "<num><unit>").when(unit, "<unit>")
    if named:
        # Not at the start of a sentence: the word before ends in none of its marks.
        within = F.coalesce(~before.rlike(r"[.!?:…][\"'”’)»]*$"), F.lit(False))
        typed = typed.when(within & bare.rlike(r"^\p{Lu}\p{Ll}+(?:[-'’]\p{L}+)*$"), "<name>")
    return typed.otherwise(plain_word(word))


def _is_plain(template: Column) -> Column:
    return ~template.rlike(_SLOT) & (_key(template) != "")


def templates(words: Column, named: bool) -> Column:
    """The template of each word but the first of ``words``, which is context only."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: _typed(F.get(words, i), F.get(words, i - 1), named)
    )


def _window(full: Column, unnamed: Column, at: Column, width: Column) -> Column:
    """A window's templates; its first word is never taken as a name, as what precedes it may differ."""
    return F.concat(F.array(F.get(unnamed, at)), F.slice(full, at + 2, width - 1))


def template_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, n_words, start, width, window, raw words, forms and anchor place of every window."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
        .where("item_id IS NOT NULL AND size(w) > 0")
        .withColumn("led", F.concat(F.array(F.lit(".")), F.col("w")))
        .select("item_id", "w", templates(F.col("led"), True).alias("full"), templates(F.col("led"), False).alias("unnamed"))
        .withColumn("exact", F.transform("w", plain_word))
        .where(F.exists("unnamed", _is_plain))
    )
    width = F.least(F.size("w"), F.lit(WINDOW))
    windows = items.select(
        "item_id", "w", "full", "unnamed", "exact", F.size("w").alias("n_words"), width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.size("w") - width)).alias("start"),
    )
    windows = windows.select(
        "item_id", "n_words", "width", "start",
        _window(F.col("full"), F.col("unnamed"), F.col("start"), F.col("width")).alias("window"),
        *[F.slice(c, F.col("start") + 1, F.col("width")).alias(name) for c, name in (("w", "raw"), ("unnamed", "unnamed"), ("exact", "exact"))],
    )
    named = F.size(F.filter("window", _is_plain)) >= PLAIN
    windows = windows.withColumn("named", named).withColumn("basis", F.when(named, F.col("window")).otherwise(F.col("unnamed")))
    windows = windows.withColumn("typed", F.size(F.filter("basis", _is_plain)) >= PLAIN)
    # Without a template, any word can be the anchor.
    is_plain = F.when(F.col("typed"), F.transform("basis", _is_plain)).otherwise(F.transform("exact", lambda x: F.lit(True)))
    places = F.filter(F.sequence(F.lit(0), F.size("window") - 1), lambda i: F.get(is_plain, i))
    key = F.transform(F.when(F.col("typed"), F.col("basis")).otherwise(F.col("exact")), _key)
    forms = F.when(F.col("named"), F.array("window", "unnamed", "exact")).when(F.col("typed"), F.array("unnamed", "exact")).otherwise(F.array("exact"))
    best = F.array_max(F.transform(places, lambda i: F.struct(F.length(F.get(key, i)).alias("len"), F.get(key, i).alias("word"), (-i).alias("neg"))))
    # A plain word next to the anchor, if there is one: it is looked at before anything is typed.
    side = F.when(F.coalesce(F.get("is_plain", F.col("offset") + 1), F.lit(False)), 1).when(F.coalesce(F.get("is_plain", F.col("offset") - 1), F.lit(False)), -1).otherwise(0)
    return (
        windows.where(F.col("width") >= PLAIN)
        .withColumn("best", best)
        .withColumn("key", key)
        .withColumn("is_plain", is_plain)
        .select(
            "item_id", "n_words", "start", "width", "window", "raw",
            F.array_distinct(forms).alias("forms"), F.exists("unnamed", _is_plain).alias("has_plain"), F.col("best.word").alias("anchor"), (-F.col("best.neg")).alias("offset"), "key", "is_plain",
        )
        .withColumn("side", side)
        .withColumn("beside", F.when(F.col("side") != 0, F.get("key", F.col("offset") + F.col("side"))).otherwise(F.lit("")))
        .drop("key", "is_plain")
    )


def matched_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(document, item_id, n_words, start, width, at, window, raw, seen, has_plain): windows found, ``at`` in words."""
    shape = F.struct("offset", "width", "side", "beside")
    anchors = kept(windows.groupBy("anchor").agg(F.collect_set(shape).alias("shapes")), "anchors")
    plain = documents(docs)
    words = plain.select(document_key(plain).alias("document"), _words(F.col("text")).alias("words"))
    n, least = anchors.agg(F.count(F.lit(1)), F.coalesce(F.min(F.octet_length("anchor")), F.lit(1))).first()
    small = n <= BROADCAST_ROWS
    beside = ["words"] if small else []
    every = words.select("document", "words", _keys(F.col("words")).alias("keys")).select("document", *beside, F.posexplode("keys").alias("pos", "key"))
    every = every.where(F.octet_length("key") >= least)
    near = every.join(shrink(anchors, n), F.col("key") == F.col("anchor")).select("document", *beside, "pos", F.explode("shapes").alias("s"))
    if not small:
        # Only places and keys were shuffled; the words come back to the documents with an anchor.
        near = kept(near, "anchored").join(words, "document")
    at = F.col("pos") - F.col("s.offset")
    fits = (at >= 0) & (at + F.col("s.width") <= F.size("words"))
    beside = (F.col("s.side") == 0) | (_key(F.get("words", F.col("pos") + F.col("s.side"))) == F.col("s.beside"))
    # The words of the window, with the one in front as context.
    before = F.coalesce(F.get("words", at - 1), F.lit("."))
    # (The optimizer may put this ahead of the filter, where a slice from 0 would fail.)
    led = F.concat(F.array(before), F.slice("words", F.greatest(at + 1, F.lit(1)), F.col("s.width")))
    # Kept, so that nothing is typed before the neighbour was looked at, and each window once.
    tried = kept(near.where(fits & beside).select("document", at.alias("at"), led.alias("led")).distinct(), "near")
    tried = tried.select(
        "document", "at", "led", templates(F.col("led"), True).alias("full"),
        templates(F.col("led"), False).alias("unnamed"),
    )
    tried = tried.select(
        "document",
        "at",
        "unnamed",
        F.concat(F.slice("unnamed", 1, 1), F.slice("full", 2, F.greatest(F.size("full") - 1, F.lit(0)))).alias("named"),
        F.slice("led", 2, F.size("led")).alias("seen"),
    )
    seen_forms = F.array_distinct(F.array("named", "unnamed", F.transform("seen", plain_word)))
    tried = tried.select("document", "at", "seen", F.explode(seen_forms).alias("seen_form")).withColumn("hash", F.xxhash64("seen_form"))
    looked_up = windows.select("item_id", "n_words", "start", "width", "window", "raw", "has_plain", F.explode("forms").alias("form")).withColumn("hash", F.xxhash64("form"))
    hit = tried.join(shrink(looked_up, looked_up.count()), "hash").where(F.col("seen_form") == F.col("form"))
    return hit.select("document", "item_id", "n_words", "start", "width", "at", "window", "raw", "seen", "has_plain").distinct()


def document_key(docs: DataFrame) -> Column:
    """A document's id as text; the digest of its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("sha256:"), F.sha2(docs["text"].cast("string"), 256)), F.lit(""))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it holds.

    doc_id, item_id, item_words, covered_words, n_windows, n_slots, reparameterised.
    """
    found = _found(docs, benchmark)
    own = F.when(~F.col("document").startswith("sha256:"), F.col("document")).cast("long")
    return found.withColumn("document", own).withColumnRenamed("document", "doc_id")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of :func:`leaks` by document key."""
    windows = kept(template_windows(benchmark), "windows")
    hits = kept(matched_windows(docs, windows).withColumn("diagonal", F.col("at") - F.col("start")), "hits")
    key = ["document", "item_id", "diagonal"]
    # Slots: words whose template is a placeholder.
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("window") - 1), lambda i: F.get("window", i).rlike(_SLOT)),
        lambda i: F.struct((F.col("start") + i).alias("place"), plain_word(F.get("raw", i)).alias("item"), plain_word(F.get("seen", i)).alias("doc")),
    )
    slots = hits.select(*key, F.explode(pairs).alias("p")).select(*key, "p.place", "p.item", "p.doc").distinct()
    # One value of the item, one value in the document.
    values = slots.groupBy(*key, "item").agg(F.count_distinct("doc").alias("docs"), F.max((F.col("item") != F.col("doc")).cast("int")).alias("differs"), F.count_distinct("place").alias("places"))
    slot = values.groupBy(*key).agg(F.max("docs").alias("most"), F.max("differs").alias("differs"), F.sum("places").alias("n_slots"))
    # Windows without a changed slot, or without a value that meets several.
    torn = values.where("docs > 1").groupBy(*key).agg(F.collect_set("item").alias("torn"))
    held = lambda p: (p["item"] == p["doc"]) | ~F.array_contains("torn", p["item"])
    steady = hits.join(torn, key, "left").withColumn("steady", F.col("torn").isNull() | F.forall(pairs, held))
    covered = (
        steady.select(*key, "n_words", "has_plain", "steady", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("width") - 1)).alias("place"))
        .groupBy(*key, "n_words")
        .agg(F.count_distinct("place").alias("covered"), F.count_distinct(F.when(F.col("steady"), F.col("place"))).alias("steady"), F.max("has_plain").alias("has_plain"))
        # Placeholders alone do not count.
        .where("has_plain")
    )
    counts = hits.groupBy(*key).agg(F.count_distinct("start").alias("n_windows"))
    rows = covered.join(counts, key).join(slot, key, "left")
    consistent = F.coalesce("most", F.lit(1)) <= 1
    rows = rows.where(F.when(consistent, F.col("covered") >= F.least(F.lit(COVER), F.col("n_words"))).otherwise(F.col("steady") >= COVER + WINDOW))
    rows = rows.withColumn("covered", F.when(consistent, F.col("covered")).otherwise(F.col("steady")))
    best = F.max(F.struct("covered", "n_windows", "n_words", F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("differs", F.lit(0)).alias("differs")))
    return rows.groupBy("document", "item_id").agg(best.alias("b")).select(
        "document", "item_id",
        F.col("b.n_words").cast("long").alias("item_words"),
        F.col("b.covered").alias("covered_words"),
        F.col("b.n_windows").alias("n_windows"),
        F.col("b.n_slots").cast("long").alias("n_slots"),
        (F.col("b.differs") > 0).alias("reparameterised"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    named = docs.withColumn(KEY, document_key(docs))
    return without(named, _found(docs, benchmark).select(F.col("document").alias(KEY))).drop(KEY)
