"""Personal data: rules against plain regular expressions, the model against numeric gradients and brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from policylens.llm import pii
from policylens.llm.queries import spark_queries


def rule_spans(text):
    """The rules as written: one regular expression per kind."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


SAMPLES = ["", "a@b", "a@b.c", "x..y@h-.com.", "@@a@b.c@d.e", "a@b.c.d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "1..2.3.4.5",
           "999.1.1.1 001.02.3.4", "+1 (743) 555-3824", "+1--2", "4111 1111 1111 1111", "4111-1111-1111-1112",
           "++12 345 678 901", "mail x@y.zz, 10.0.0.1; +44 20 7946 0958 end", "0" * 30, "ü@é.com a_b@c.d"]


def test_rules_equal_the_expressions():
    rnd = random.Random(3)
    noise = ["".join(rnd.choice("ab1290..@+- ()é\n") for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    for text in SAMPLES + noise:
        assert pii.base_spans(text) == rule_spans(text), text
    assert pii.base_spans(None) == []


def test_rules_take_linear_time_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 200_000, "a@" * 100_000, "+1" + "(" * 200_000):
        pii.base_spans(text)


def test_gradients_are_numeric_gradients(monkeypatch):
    rng = np.random.default_rng(0)
    model = pii.BiLstmCrf()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.p["pairs"] = rng.standard_normal(model.p["pairs"].shape)
    model.p["first"] = rng.standard_normal(model.p["first"].shape)
    chars, tags = rng.integers(0, pii.CHARS, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    _, g = model.loss_and_gradients(chars, tags)
    for name in model.p:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in model.p[name].shape)
            if name.startswith("in_"):
                at = (int(chars[0, 2]), at[1])
            old, eps = model.p[name][at], 1e-2
            model.p[name][at] = old + eps
            up = model.loss_and_gradients(chars, tags)[0]
            model.p[name][at] = old - eps
            down = model.loss_and_gradients(chars, tags)[0]
            model.p[name][at] = old
            assert g[name][at] == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=2e-3), name


def test_decoding_is_the_best_sequence():
    rng = np.random.default_rng(1)
    model = pii.BiLstmCrf()
    model.p["pairs"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    scores = rng.standard_normal((2, 4, pii.TAGS)).astype(np.float32)
    got = model.decode(scores, np.array([4, 3]))
    for row, length in enumerate((4, 3)):
        def value(seq, row=row):
            return (model.p["first"][seq[0]] + sum(scores[row, t, x] for t, x in enumerate(seq))
                    + sum(model.p["pairs"][a, b] for a, b in itertools.pairwise(seq)))
        assert tuple(got[row].tolist()) == max(itertools.product(range(pii.TAGS), repeat=length), key=value)


def test_tags_and_spans_round_trip():
    spans = [(0, 3, 4), (4, 3, 6), (8, 0, 9)]
    assert pii.spans_of(pii.tags_of(10, spans)) == spans
    assert pii.spans_of(np.zeros(0, int)) == [] and pii.spans_of(np.zeros(5, int)) == []


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    words = "the of and token version said meet license house number on call at".split()

    def card():
        d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    def one():
        return rnd.choice([f"{rnd.choice(words)}.{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com",
                           ".".join(str(rnd.randint(1, 255)) for _ in range(4)), card(),
                           f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}",
                           f"version {rnd.randint(1, 9)}.0", f"{rnd.randint(1900, 2050)}",
                           'token = "' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"'])
    return [" ".join(rnd.choice(words) if rnd.random() < 0.9 else one() for _ in range(60)) for _ in range(500)]


@pytest.fixture(scope="module")
def model(texts):
    chars, tags = pii.training_windows(texts[:400])
    return pii.BiLstmCrf().fit(chars, tags)


def test_model_learns_the_spans(model, texts):
    """Held-out texts: the decoded spans agree with the rules' ones."""
    right = wrong = missed = 0
    for text in texts[400:]:
        want = set(pii.base_spans(text))
        got = {(a + x, k, a + y) for a, b in pii.stretches(text) for x, k, y in pii.spans_of(model.tag([text[a:b]])[0])}
        right, wrong, missed = right + len(want & got), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_base_spans_stay_and_added_ones_are_plausible(model):
    text = "call me at (743) 555-3824 or mail joe.7 [at] mail3.example.com, card 4111 1111 1111 1111 and 10.2.3.4 today"
    (base, every), (none, also) = pii.find([text, None], model)
    assert set(base) <= set(every) and none == also == []
    for a, k, b in set(every) - set(base):
        assert pii.plausible(k, text[a:b])
    assert pii.find([text], None)[0][0] == pii.find([text], None)[0][1] == base
    assert any(k == 3 for _, k, _ in every)


def test_windows_are_reconciled_over_long_stretches(model):
    text = "on call +1 (743) 555-3824 the " * 40
    (base, every), = pii.find([text], model)
    assert len(base) == 40 and every == base


class Decoded:
    """A model that finds the given pieces of text."""

    def __init__(self, *pieces):
        self.pieces = pieces

    def tag(self, texts):
        return [pii.tags_of(len(t), [(t.find(p), k, t.find(p) + len(p)) for k, p in self.pieces if p in t])
                for t in texts]


def added(text, *pieces):
    (base, every), = pii.find([text], Decoded(*pieces))
    return {(k, text[a:b]) for a, k, b in set(every) - set(base)}


def test_parts_of_a_failed_match_are_added():
    one, second = "4012888888881881", "4111 1111 1111 1111"
    assert pii.base_spans(f"x {one} {second} y") == []
    assert added(f"x {one} {second} y", (2, one), (2, second)) == {(2, one), (2, second)}
    assert added(f"x {one} {second} y", (2, second)) == {(2, one), (2, second)}
    assert added(f"x {one} {second} y", (2, f"{one} {second}")) == {(2, one), (2, second)}
    phone = "+1 (826) 555-4081"
    assert added(f"{phone} 190.137.223.204", (3, phone)) == {(3, phone)}
    dotted = "4111.1111.1111.1111"                       # four matches that fail
    assert added(f"card {dotted} end", (2, dotted)) == {(2, dotted)}


def test_what_a_rule_rejected_is_not_added():
    assert added("x 4111 1111 1111 1112 y", (2, "4111 1111 1111 1112")) == set()
    assert added("call +1 (826) 555 4081 99999 now", (3, "1 (826) 555 4081 99999")) == set()
    run = "4111111111111111" + "99999"                   # no part of one run of digits
    assert added(f"x {run} y", (2, run[:16])) == set()
    assert added("x 999.1.1.1 y", (1, "99.1.1.1")) == set()


def test_model_finds_two_numbers_in_a_row(model):
    """The rules find none of these cards and phones."""
    rnd = random.Random(11)

    def card():
        d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    found = {"card": 0, "phone": 0}
    for _ in range(40):
        one, two, ip = card(), card(), ".".join(str(rnd.randint(100, 255)) for _ in range(4))
        phone = f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
        for kind, text, want in (("card", f"of the house {one} {two} said on", {one, two}),
                                 ("phone", f"of the house {phone} {ip} said on", {phone})):
            (base, every), = pii.find([text], model)
            found[kind] += {text[a:b] for a, _, b in set(every) - set(base)} == want
    assert min(found.values()) >= 28, found


def test_two_numbers_in_a_row_are_trained_on():
    chars, tags = pii.training_windows(["pay 4111 1111 1111 1111 from +1 (826) 555-4081 or 10.2.3.4 today"] * 3)
    assert max(len(pii.spans_of(t)) for t in tags) >= 2
    for t in tags:
        spans = pii.spans_of(t)
        if any(b + 1 == c for (_, _, b), (c, _, _) in itertools.pairwise(spans)):
            return
    raise AssertionError("no window with two numbers in a row")


def test_long_names_and_hosts_are_read_whole(model):
    name, host = "a.very.long.name.of.a.person.in.an.office", "some-long-subdomain.of.example-company.com"
    for sign in (" @ ", "(at)", " [at] ", " (AT) "):
        text = f"write to {name}{sign}{host} about it"
        whole = name + sign + host
        assert any(whole in text[a:b] for a, b in pii.stretches(text)), sign
        assert added(text, (0, f"office{sign}some-long-subdomain.of.exa")) == {(0, whole)}
    text = f"mail to {name} @ {host} 1 " + "x" * 100 + " 2"
    parts = pii.stretches(text)
    assert all(b < c for (_, b), (c, _) in itertools.pairwise(parts))


def test_stretches_take_linear_time():
    for text in ("@" * 100_000, "a@" * 50_000, "a" * 300_000 + "@", " " * 300_000 + "@", "b(at)" * 50_000, "1 " * 100_000):
        pii.stretches(text)


def test_frame(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts[:300])] + [(None, None, "x"), (7, "", None), (7, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans_of string")
    got = pii.personal_data(df.select("doc_id", "text"), pii.train(df)).collect()
    assert len(got) == 303
    for r in got:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        if r["doc_id"] is not None and r["doc_id"] != 7:
            want = pii.written(rule_spans(texts[r["doc_id"]]))
            assert set(filter(None, want.split(","))) <= {":".join(s) for s in spans}
    clash = pii.personal_data(df.limit(9).withColumn("spans", F.lit("x")).withColumn("n_card", F.lit("x")), None)
    assert dict(clash.dtypes)["n_card"] == "bigint" and clash.columns.count("spans") == 1 and clash.count() == 9
    empty = df.limit(0)
    assert pii.train(empty) is None and pii.personal_data(empty.select("doc_id", "text"), None).count() == 0


def test_query_counts_the_rules_spans(spark, tmp_path):
    added = "cards 4111 1111 1111 1111 5500 0000 0000 0004 in a row"        # the rules see one number and drop it
    rows = [(i, f"mail a{i}.b@c{i}.org, host 10.0.{i % 256}.7, call +49 30 1234 56{i:03d}, pay 4111-1111-1111-1111 ok {added}")
            for i in range(300)] + [(1000, None), (1001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    more = 0
    for r in spark_queries()["op8_pii"](spark, str(tmp_path)).collect():
        base = rule_spans(dict(rows)[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(len(pii.KINDS))]
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        more += len(list(filter(None, r["spans"].split(",")))) - len(base)
    assert more > 0
