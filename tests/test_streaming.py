"""Streaming policy indicators: files arriving in two batches, one checkpoint."""

from policylens.plans.policy import policy_indicators
from policylens.queries import WINDOW
from policylens.session import scratch_path
from policylens.sources.adapter import sources_for
from policylens.streaming.policy_stream import policy_extract_stream, read_sink, run_available
from tests.conftest import SF_SMALL


def key(r):
    return tuple((x is None, str(x)) for x in r)


def test_incremental_files_processed_once(spark):
    src = sources_for(spark, SF_SMALL)
    folder, sink, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    policy = src.policy
    first = policy.where("substring(policyno, -1) < '5'")
    rest = policy.where("substring(policyno, -1) >= '5'")

    first.write.json(f"{folder}/batch1")
    run_available(policy_extract_stream(spark, f"{folder}/*"), src, WINDOW, sink, ckpt)
    after_first = read_sink(spark, sink).count()

    rest.write.json(f"{folder}/batch2")
    run_available(policy_extract_stream(spark, f"{folder}/*"), src, WINDOW, sink, ckpt)
    streamed = read_sink(spark, sink)

    expected = policy_indicators(src, WINDOW)
    assert 0 < after_first < expected.count()
    assert sorted(map(tuple, streamed.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
