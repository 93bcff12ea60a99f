from pyspark.sql import functions as F

from caselake.llm import quality


def test_every_trigram_has_a_slot(spark, monkeypatch):
    """Words with equal edges differ, and long words are cut as short ones are."""
    words = ["stated", "sealed", "a", "né", "x" * 70 + "yz", "😀b"]
    df = spark.createDataFrame([(words,), ([],)], "words array<string>")
    grams = [f" {w} "[i:i + 3] for w in words for i in range(len(w))]
    slot = F.pmod(F.xxhash64("gram"), F.lit(1000)).cast("int")
    expected = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram string").coalesce(1).select(slot).collect()]
    assert [r["slots"] for r in quality.with_slots(df, 1000).collect()] == [expected, []]
    monkeypatch.setattr(quality, "SHORT", 3)
    assert [r["slots"] for r in quality.with_slots(df, 1000).collect()] == [expected, []]


def test_slot_rows_are_the_slots_of_all_words(spark, monkeypatch):
    """Row by row as the arrays say, texts with long words or none included, and compiled."""
    rows = [(1, ["stated", "a", "né", "😀b"]), (0, ["x" * 70 + "yz", "a"]), (1, []), (0, ["x" * 62, "y" * 63]), (1, ["stated"])]
    df = spark.createDataFrame(rows, "target int, words array<string>")
    expected = sorted((r["target"], s) for r in quality.with_slots(df, 1000).collect() for s in r["slots"])
    made = quality.slot_rows(df, 1000, "target")
    assert made.columns == ["target", "slot"]
    assert sorted(map(tuple, made.collect())) == expected
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not any("Generate" in line and "lambda" in line for line in plan.splitlines())
    monkeypatch.setattr(quality, "SHORT", 4)
    assert sorted(map(tuple, quality.slot_rows(df, 1000, "target").collect())) == expected


def test_sums_by_words_are_the_sums_of_all_trigrams(spark, monkeypatch):
    """Words that are looked up, lost their place to another, or were never counted; counts come from different words."""
    texts = ["the cat sat on the mat " * 3, "the né 😀b the cat", "x" * 70 + " sat " + "x" * 70, "never 1 2 3", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    rules = quality.QualityRules(buckets=1000)
    counts = quality.word_counts(docs, labels, rules)
    assert {r["word"]: (r["corpus"], r["target"]) for r in counts.collect()}["the"] == (8, 6)
    slots = quality.with_slots(docs.withColumn("words", quality.words_of(quality.whole_text())), 1000)
    marked = slots.select("doc_id", "slots").collect()
    corpus, target = [0] * 1000, [0] * 1000
    for r in marked:
        for slot in r["slots"]:
            corpus[slot] += 1
            target[slot] += r["doc_id"] in (0, 2)
    log = quality.log
    expected = [round(log((t + 1) / (sum(target) + 1000)) - log((c + 1) / (sum(corpus) + 1000)), 6)
                for c, t in zip(corpus, target)]
    ratios = quality.log_ratios(counts, rules)
    assert slots.select(ratios.alias("r")).first()["r"] == expected
    for places in (1, 4, 1 << 10):
        monkeypatch.setattr(quality, "PLACES", places)
        sums = slots.select("slots", quality.text_sum(counts, ratios, rules).alias("s")).collect()
        assert all(abs(r["s"] - sum(expected[x] for x in r["slots"])) < 1e-9 for r in sums)
    judged = quality.assess(docs, labels, rules).select("doc.doc_id", "score").collect()
    means = {r["doc_id"]: sum(expected[x] for x in r["slots"]) / max(len(r["slots"]), 1) for r in marked}
    assert all(abs(r["score"] - means[r["doc_id"]]) < 1e-9 for r in judged)


def test_windows_are_sorted_once(spark):
    df = spark.createDataFrame([([1, 2, 1, 3, 2, 1],)], "g array<bigint>")
    found = df.select(quality._covered(F.col("g"), 2).alias("n"))
    assert found.first()["n"] == 7
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 2  # the windows, and the places of those met again
