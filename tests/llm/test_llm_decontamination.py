from llm_fixtures import as_rows, empty, messy, plain_texts, prose
from tidemark.llm.decontamination import WINDOW, clean, leaks, template_windows

ITEM = "A train leaves Boston at 60 km per hour and arrives after 3 hours, so how far away is Boston from the station?"
OTHER = ITEM.replace("60", "85").replace("Boston", "Madrid").replace("3 hours", "7 days")
MIXED = ITEM.replace("from the station", "from the").replace("leaves Boston", "leaves Madrid")


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id BIGINT, text STRING")


def test_whole_passages_equal_brute_force(spark):
    rows = [(d, t) for d, t, _ in plain_texts()]
    items = [(1, prose(2, 90)), (2, prose(77, 30)), (3, None), (4, ""), (5, "one two"), (None, prose(1, 120)), (6, prose(1, 120))]
    got = as_rows(leaks(messy(spark), bench(spark, items)), "doc_id", "item_id")
    wanted = set()
    for d, t in rows:
        for i, text in items:
            if i is not None and text and len(text.split()) >= WINDOW and f" {text.lower()} " in f" {t.lower()} ":
                wanted.add((d, i))
    near = {(3, 6)}  # one word of 120 differs
    assert set(got) == wanted | near


def test_reparameterised_question_is_found_and_told(spark):
    texts = [prose(1, 30) + ". " + t + " " + prose(2, 30) for t in (ITEM, OTHER, MIXED)] + [prose(3, 80)]
    got = {r["doc_id"]: r for r in leaks(docs_of(spark, texts), bench(spark, [(9, ITEM)])).collect()}
    assert sorted(got) == [0, 1]  # the third says Madrid for one Boston and Boston for the other
    assert not got[0]["reparameterised"] and got[1]["reparameterised"] and got[1]["n_slots"] >= 4
    assert got[0]["covered_words"] == got[0]["item_words"] == len(ITEM.split())


def test_windows_of_placeholders_alone_do_not_count(spark):
    numbers = "1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    assert template_windows(bench(spark, [(1, numbers)])).count() == 0
    assert leaks(docs_of(spark, [numbers]), bench(spark, [(1, numbers)])).count() == 0


def test_clean_keeps_the_rest_with_all_columns(spark):
    docs = messy(spark)
    left = clean(docs, bench(spark, [(1, prose(2, 90))]))
    assert left.columns == docs.columns
    assert sorted(map(repr, left.select("doc_id").collect())) == sorted(map(repr, docs.where("doc_id IS NULL OR doc_id NOT IN (10, 11)").select("doc_id").collect()))
    assert clean(docs, bench(spark, [])).count() == docs.count()
    assert clean(empty(spark), bench(spark, [(1, prose(2, 90))])).count() == 0


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    from tidemark.llm import tables

    texts = [prose(1, 30) + ". " + t for t in (ITEM, OTHER)] + [prose(3, 80)]
    wanted = as_rows(leaks(docs_of(spark, texts), bench(spark, [(9, ITEM)])), "doc_id", "item_id", "n_windows")
    monkeypatch.setattr(tables, "shrink", None)
    from tidemark.llm import decontamination

    monkeypatch.setattr(decontamination, "shrink", lambda df, rows: df.hint("shuffle_hash"))
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", -1)
    assert as_rows(leaks(docs_of(spark, texts), bench(spark, [(9, ITEM)])), "doc_id", "item_id", "n_windows") == wanted


def test_documents_without_an_id_are_searched(spark):
    held = prose(1, 30) + ". " + ITEM
    docs = spark.createDataFrame([(None, held), (None, prose(4, 50)), (None, None), (7, held), (None, held)], "doc_id BIGINT, text STRING")
    items = bench(spark, [(9, ITEM)])
    assert sorted(map(repr, (r["doc_id"] for r in leaks(docs, items).collect()))) == ["7", "None"]
    assert sorted(map(repr, clean(docs, items).collect())) == sorted(map(repr, docs.where("doc_id IS NULL AND (text IS NULL OR NOT contains(text, 'Boston'))").collect()))


def test_numbers_written_out_and_units_glued_on(spark):
    item = "Water flows into the tank at 5.5 litres per second for thirty minutes, then a pump drains it at 60km/h of air speed until dusk falls"
    other = item.replace("5.5", "five").replace("thirty", "45").replace("60km/h", "ninety-two km/h").replace("60km/h", "80 km/h")
    glued = item.replace("60km/h", "75km/h").replace("thirty", "forty")
    got = leaks(docs_of(spark, [other, glued, prose(3, 60)]), bench(spark, [(1, item)])).collect()
    assert sorted((r["doc_id"], r["reparameterised"]) for r in got) == [(0, True), (1, True)]


def test_main_path_is_native(spark, plan_of):
    from tidemark.llm.decontamination import matched_windows

    windows = template_windows(bench(spark, [(9, ITEM)]))
    text = plan_of(matched_windows(docs_of(spark, [OTHER]), windows), "simple")
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_verbatim_copies_are_found_by_raw_words(spark):
    items = [
        (1, "Which of the rivers Rhine, Elbe, Oder, Main, Saar ends 1233 km"),
        (2, "Who wrote Anna Karenina?"),
        (3, "Calculate 12 + 7 * 3 - 4"),
        (4, "\u4e3a\u4ec0\u4e48\u5929\u7a7a\u662f\u84dd\u8272\u7684\uff1f"),
    ]
    texts = [prose(1, 20) + ". " + t + " " + prose(2, 20) for _, t in items[:3]]
    texts += ["\u8bf7\u95ee\u4e3a\u4ec0\u4e48\u5929\u7a7a\u662f\u84dd\u8272\u7684\uff0c\u8c22\u8c22", "Calculate 12 + 8 * 3 - 4"]
    got = leaks(docs_of(spark, texts), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_one_changed_name_does_not_hide_a_long_copy(spark):
    words = prose(5, 59).split()
    words[10] = words[40] = "Boston"
    changed = [*words[:40], "Madrid", *words[41:]]
    apples = f"{prose(6, 25)} 2 apples {prose(7, 25)} 2 dollars {prose(8, 25)}"
    other = apples.replace("2 apples", "3 apples").replace("2 dollars", "5 dollars")
    got = leaks(docs_of(spark, [" ".join(changed), other]), bench(spark, [(1, " ".join(words)), (2, apples)])).collect()
    assert sorted((r["doc_id"], r["item_id"], r["reparameterised"]) for r in got) == [(0, 1, True), (1, 2, True)]


def test_capitals_of_names_do_not_hide_a_copy(spark):
    words = prose(9, 40).split()
    item = " ".join(w.capitalize() if k % 4 == 3 else w for k, w in enumerate(words))
    texts = [item, item.lower(), item.upper()]
    for texts, text in ((texts, item), (texts, item.lower())):
        got = leaks(docs_of(spark, texts), bench(spark, [(1, text)])).collect()
        assert sorted((r["doc_id"], r["covered_words"]) for r in got) == [(0, 40), (1, 40), (2, 40)]
