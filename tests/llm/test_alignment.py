"""Alignment against the libraries and the written-out definition, the perfect hash, and the defined cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from policylens.llm.alignment import Tokenizers, aligned
from policylens.llm.common import read_table, stage
from policylens.llm.perfect_hash import PerfectHash
from policylens.llm.queries import vocabulary
from policylens.llm.tokens import byte_symbols
from tests.conftest import SF_SMALL

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a   b \n c", "\n", "x\n y", "x\n \ty", "x \n", "\t tab", "it's o'clock",
       "<|endoftext|> and <s></s> <0x41>", "▁ low line", "a▁b", "naïve café — “quoted”", "東京都 は 日本", "🙂🙃 👩‍👩‍👧 x", " hard space ",
       "é combining", "control \x01\x1c\x1d y", "zero​width", "a" * 500, "1234567890" * 30, "\r\n\r\n", "nul\x00in"]


class Defined:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {s: i for i, s in enumerate(byte_symbols())}

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i in b for p in [self.b.id_to_piece(i)]]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
        out, own = [], ([], [])
        at = bt = 0
        for end in sorted({*ends_a} & {*ends_b}):
            own = ([], [])
            while at < len(a) and ends_a[at] <= end:
                own[0].append(a[at])
                at += 1
            while bt < len(b) and ends_b[bt] <= end:
                own[1].append(b[bt])
                bt += 1
            out.append(own)
        return out


def defined(rows):
    one = Defined()
    groups = [one.groups(text) for _, text, *_ in rows]
    count = Counter(p for g in groups for p in {(x, y) for a, b in g for x in a for y in b})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (doc_id, *_), g in zip(rows, groups):
        links = [(x, y) for a, b in g for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def rows(spark):
    docs = [(r["doc_id"], r["text"], "x", None) for r in read_table(spark, SF_SMALL, "documents").collect()]
    rnd = random.Random(11)
    odd = [(10_000 + i, t, None, "y") for i, t in enumerate(ODD)]
    odd += [(20_000 + i, "".join(rnd.choices(" \n\taé▁'9東.🙂", k=rnd.randrange(1, 40))), None, None) for i in range(300)]
    return [*docs, *odd, (None, "hot copy", None, None), *[(30_000, "hot copy", None, None)] * 200]


def frame(spark, rows):
    return stage(spark.createDataFrame(rows, "doc_id long, text string, n_a string, block string").repartition(4),
                 "align-test")


def test_aligned_is_the_definition(spark, rows):
    got = aligned(frame(spark, rows), A, B, block_bytes=50_000, shard_pairs=1 << 27, lane_blocks=2)
    assert result(got) == defined(rows)


def test_groups_meet_in_many_partitions(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = aligned(frame(spark, rows[:60]), A, B, block_bytes=20_000, shard_pairs=1 << 29, lane_blocks=1)
        assert result(got) == defined(rows[:60])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_and_tokenless_tables(spark):
    assert aligned(frame(spark, []), A, B, shard_pairs=1 << 27).count() == 0
    rows = [(1, None, "", ""), (1, "", "", ""), (None, "a▁b", None, None)]
    assert result(aligned(frame(spark, rows), A, B, shard_pairs=1 << 27)) == defined(rows)


def test_a_very_long_text(spark):
    rnd = random.Random(3)
    rows = [(1, " ".join("".join(rnd.choices("abcdé", k=5)) for _ in range(60_000)), None, None), (2, "abc", None, None),
            (3, "ab" * 40_000, None, None)]
    assert result(aligned(frame(spark, rows), A, B, shard_pairs=1 << 27)) == defined(rows)


def test_segments_are_forgotten_in_time(monkeypatch):
    from policylens.llm import alignment
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    both = Tokenizers(A, B)
    for text in ("one two three four five", "six seven", "one two"):
        places, n = both.segments([text])
        assert n.tolist() == [len(text.split())]
        assert both.found.numbers[places, 0].sum() == len(Tokenizer.from_file(A).encode(" " + text).ids)
    assert len(both.found) <= 7


def test_large_groups_are_counted_by_multiplicity(monkeypatch, rows):
    from policylens.llm import alignment
    texts = [r[1] for r in rows[-600:]]
    one, two = Tokenizers(A, B), Tokenizers(A, B)
    one.segments(texts, groups=True)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    monkeypatch.setattr(alignment, "MANY", 7)
    two.segments(texts, groups=True)

    def by_segment(both):
        out = {}
        for segment, i in both.known.items():
            own = slice(both.found.starts[i], both.found.starts[i + 1])
            out[segment] = (both.found.numbers[i].tolist(), both.found.pairs[own].tolist(),
                            both.found.times[own].tolist(), both.found.text[i])
        return out

    assert by_segment(one) == by_segment(two)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_survives_bytes(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**62, n + n // 10, dtype=np.int64))[:n]
    own = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
    assert own.size == n and sorted(own.index(keys).tolist()) == list(range(n))
    others = np.setdiff1d(np.arange(1000, dtype=np.int64), keys)
    at = own.index(others)
    assert (at < n).all()
