"""Mixing, language ID, quality and fingerprints: definitions, held-out accuracy and edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from policylens.llm import langid, quality, spotsigs
from policylens.llm.common import stage
from policylens.llm.mixing import mix, mixed_documents
from tests.conftest import SF_ORACLE


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- mixing ---

MIX = "doc_id long, text string, source string, n_chars long, size string, target int"


@pytest.fixture(scope="module")
def mix_rows():
    rnd = random.Random(3)
    rows = [(i, "\t".join(["w"] * rnd.randint(0, 30)) + " ", rnd.choice(["hot", "hot", "hot", "b", "é", None]), 1, "x", 1)
            for i in range(600)]
    return [*rows, rows[5], (None, "a b c", "b", None, None, None), (7000, None, None, None, None, None),
            (7001, "long " * 20_000, "z", 1, None, None)]


def test_mix_meets_its_targets(spark, mix_rows):
    docs = stage(spark.createDataFrame(mix_rows, MIX).repartition(3), "mix-test")
    got = mix(docs).collect()
    assert len(got) == len(mix_rows)
    per = {}
    for r in got:
        taken = r["epochs"] * r["size"] + r["part"]
        assert 0 <= taken <= 2 * r["size"]
        size, target, total = per.setdefault(r["source"], [r["source_size"], r["target"], 0])
        per[r["source"]][2] = total + taken
    for size, target, total in per.values():
        assert total == int(target) and target <= 2 * size + 1e-6
    assert sum(t for _, t, _ in per.values()) == pytest.approx(1.5 * sum(s for s, _, _ in per.values()))
    again = mix(docs.repartition(7)).collect()
    def key(r):
        return (str(r["doc_id"]), r["size"], r["epochs"], r["part"], str(r["source"]))
    assert sorted(map(key, got)) == sorted(map(key, again))                 # reruns agree


def test_mixed_documents_hold_the_words(spark, mix_rows):
    docs = stage(spark.createDataFrame(mix_rows, MIX).repartition(3), "mix-test")
    plan = {r["source"]: 0 for r in mix(docs).collect()}
    for r in mix(docs).collect():
        plan[r["source"]] += r["epochs"] * r["size"] + r["part"]
    out = mixed_documents(docs)
    assert out.dtypes == docs.dtypes
    got = dict.fromkeys(plan, 0)
    for r in out.collect():
        got[r["source"]] += len(words(r["text"]))
    assert got == plan
    assert mixed_documents(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0
    blank = docs.where(F.col("text").isNull())
    assert [(r["target"], r["part"]) for r in mix(blank).collect()] == [(0.0, 0)]


# --- language ID ---

def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs.where(~held).select("text", "lang"))
    got = langid.identify(docs.where(held).select("doc_id", "lang", "text"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_words_first_then_shorter_and_shorter_pieces(spark):
    rows = [("la casa grande", "es"), ("la casa blanca", "es"), ("the house stands", "en"), ("the white house", "en"),
            (None, "en"), ("kein", None)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["en", "es"] and "casa" in model.words and "kein" not in model.words
    assert model.predict("Casa!")[0] == "es" and model.predict("housing")[0] == "en"
    seen = model.words["house"]
    assert seen[0] > seen[1]
    # a word no language knows: its own pieces decide
    assert model.predict("casas")[0] == "es"
    for text in (None, "", "123 --- ...", "²"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("日本")[0] in model.languages                       # letters, but none seen
    assert model.predict("casa " * 300_000)[0] == "es"


def test_a_full_memory_of_words_starts_anew(spark, monkeypatch):
    rows = [(f"alpha beta w{i}", "aa") for i in range(30)] + [(f"gamma delta v{i}", "bb") for i in range(30)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = [f"alpha x{i} y{i} beta" for i in range(50)] + [f"gamma z{i} delta" for i in range(50)]
    want = [model.predict(t) for t in texts]
    model.rows.clear()
    monkeypatch.setattr(langid, "REMEMBERED", 12)
    assert [model.predict(t)[0] for t in texts] == [w for w, _ in want]


def written_out(model, text):
    """The score by its definition, place by place."""
    total = np.zeros(len(model.languages))
    for word in langid.letters_words(text):
        if word in model.words:
            total += model.words[word]
            continue
        padded = f"<{word}>"
        for i in range(len(padded) - 1):
            pieces = [padded[i:i + n] for n in (4, 3, 2, 1) if i + n <= len(padded)]
            known = [p for p in pieces if p in model.pieces]
            total += model.pieces[known[0]] / len(known[0]) if known else model.unseen
    best = int(total.argmax())
    return model.languages[best], 1.0 / np.exp(total - total[best]).sum()


def test_scores_are_the_definition(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = langid.train(docs.where("doc_id % 2 = 0").select("text", "lang"))
    texts = [r["text"] for r in docs.where("doc_id % 2 = 1 and text is not null").orderBy("doc_id").limit(150).collect()]
    texts = [t for t in texts if langid.letters_words(t)] + ["casaxyz" * 300, "q", "日本 zzz the"]
    for places in (7, langid.PLACES):
        monkeypatch.setattr(langid, "PLACES", places)
        model.rows.clear()
        for t in texts:
            (lang, score), (want, p) = model.predict(t), written_out(model, t)
            assert lang == want and score == pytest.approx(p, rel=1e-6)


def test_columns_named_as_results(spark):
    """Extra columns that clash are replaced, all others are carried; no row is lost."""
    docs = spark.createDataFrame([(1, "the house", "a", 7, "x"), (1, "the house", "a", 7, "x"), (None, None, None, None, None)],
                                 "doc_id long, text string, `lang_pred` string, score int, `carried` string")
    model = langid.train(spark.createDataFrame([("the house", "en"), ("la casa", "es")], "text string, lang string"))
    got = langid.identify(docs, model)
    assert got.columns == ["doc_id", "carried", "lang_pred", "score"]
    assert sorted(tuple(r)[:3] for r in got.collect() if r["doc_id"]) == [(1, "x", "en")] * 2 and got.count() == 3
    assert {r["lang_pred"] for r in got.collect()} == {"en", "und"}
    assert langid.identify(docs.limit(0), model).count() == 0
    assert langid.identify(docs.select("text"), model).columns == ["lang_pred", "score"]
    rated = quality.score(docs.withColumn("feature", F.lit("f")).withColumn("log_ratio", F.lit("f")),
                          quality.CompressionModel(b"", b""))
    assert rated.count() == 3 and dict(rated.dtypes)["score"] == "double" and dict(rated.dtypes)["feature"] == "double"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(empty.select("text", "lang"))
    assert model.languages == [] and model.predict("the house") == ("und", 0.0)
    assert langid.identify(empty.select("doc_id", "text"), model).count() == 0


# --- quality ---

def test_quality_of_held_out_rows(spark):
    sf = SF_ORACLE.replace("sf0.01", "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality.train(docs, labels.where(~held))
    got = quality.score(docs, model).join(labels.where(held), "doc_id").collect()
    right = sum(r["predicted"] == r["label"] for r in got)
    assert right >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    # calibrated: the mean score is close to the share of good ones
    assert abs(np.mean([r["score"] for r in got]) - np.mean([r["label"] for r in got])) < 0.03


def test_quality_without_labels_or_with_one_kind(spark):
    docs = spark.createDataFrame([(1, "good text here", "x"), (2, None, "x"), (2, "", "x"), (None, "a", None)],
                                 "doc_id long, text string, feature string")
    none = spark.createDataFrame([], "doc_id long, label int")
    one = spark.createDataFrame([(1, 1), (1, 1), (3, None), (None, 0)], "doc_id long, label int")
    for labels, share in ((none, 1 / 2), (one, 3 / 4)):
        model = quality.train(docs, labels)
        got = quality.score(docs.select("doc_id", "text"), model).collect()
        assert len(got) == 4 and all(r["score"] == pytest.approx(share) for r in got)
    assert quality.score(docs.select("doc_id", "text").limit(0), quality.train(docs, one)).count() == 0


# --- fingerprints ---

PRINTS = "doc_id long, text string, fingerprint string"


def test_every_document_meets_its_next(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["the", "of", "river", "stone", "é", "日本"]) + str(rnd.randint(0, 3))
                      for _ in range(rnd.randint(0, 40))) for _ in range(700)] + [None, "", "...", "x", "ab", "long the " * 9000]
    rnd.shuffle(texts)
    ids = rnd.sample(range(10**9), len(texts))
    df = stage(spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], PRINTS).repartition(6), "prints")
    got = {r["doc_id"]: r for r in spotsigs.compare_with_next(df).collect()}
    order = sorted(zip(ids, [t or "" for t in texts], strict=True), reverse=True)
    assert len(got) == len(order)
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        n = len(text) // 3
        other = text[:len(text) - n] + following[:n]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        a, b, c = map(spotsigs.signatures, (text, other, following))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.fingerprint(a), spotsigs.fingerprint(b))
        assert r["near_edited"] == spotsigs.likeness(a, b) and r["near_next"] == spotsigs.likeness(a, c)


@pytest.mark.parametrize("n", [1, 4])
def test_fingerprints_where_every_id_is_null(spark, n):
    got = spotsigs.compare_with_next(spark.createDataFrame([(None, "a the b" + "c" * i, None) for i in range(n)], PRINTS))
    rows = got.collect()
    assert sorted(r["n_chars"] for r in rows) == [7 + i for i in range(n)]
    assert all(r["doc_id"] is None and r["near_next"] is not None for r in rows)


def test_one_document_ties_nulls_and_no_rows(spark):
    one = spotsigs.compare_with_next(spark.createDataFrame([(4, "the lone river stone", None)], PRINTS)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    ties = [(1, "a the b", None), (1, "a the b", None), (1, "c", None), (None, "null id the end", None), (2, None, None)]
    got = spotsigs.compare_with_next(spark.createDataFrame(ties, PRINTS)).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted((str(i), len(t or "")) for i, t, _ in ties)
    assert spotsigs.compare_with_next(spark.createDataFrame([], PRINTS)).count() == 0


def test_likeness_is_jaccard_with_or_without_pruning():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint32)) for _ in range(2))
        union = len(np.union1d(a, b))
        value = len(np.intersect1d(a, b)) / union if union else 1.0
        assert spotsigs.likeness(a, b) == value
        assert spotsigs.likeness(a, b, 0.5) == (value if value >= 0.5 else 0.0)
        assert (spotsigs.parse(spotsigs.fingerprint(a)) == a).all()


def test_similar_documents_are_all_found(spark):
    docs = spark.read.parquet(f"{SF_ORACLE.replace('sf0.01', 'sf0.001')}/documents.parquet")
    got = {(r["a"], r["b"]) for r in spotsigs.similar_documents(docs, 0.6).collect()}
    prints = {}
    for r in spotsigs.fingerprint_classes(docs).collect():
        prints[r["fingerprint"]] = min(r["doc_id"], prints.get(r["fingerprint"], r["doc_id"]))
    sets = {i: spotsigs.parse(f) for f, i in prints.items() if f}
    ids = sorted(sets)
    assert got == {(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if spotsigs.likeness(sets[a], sets[b], 0.6)}


def test_few_short_lengths_do_not_hold_up_the_search(monkeypatch):
    from policylens.llm import packing

    looked = []
    dominated = packing._dominated
    monkeypatch.setattr(packing, "_dominated", lambda *a: looked.append(1) or dominated(*a))
    counts = {145: 30, 131: 40, 97: 30, 61: 40, 43: 30, 29: 40, 17: 16}
    found = list(packing.fillings(counts, 1901, 50))
    assert found and sum(x * k for x, k in found[0]) == 1901 and len(looked) <= 50 + packing.TRIES
