import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemark.llm.token_counts import count_tokens, counted_in_files, token_files, write_token_files
from lakemark.session import fresh_path


def by_hand(tokens, end):
    out, n = [], 0
    for t in tokens:
        if t == end:
            out.append(n)
            n = 0
        else:
            n += 1
    return out + ([n] if n else [])


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, and batches of a few lines."""
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "30"}
    before = {name: spark.conf.get(name) for name in [*settings, "spark.sql.files.maxPartitionBytes"]}

    def use(size):
        for name, value in (settings | {"spark.sql.files.maxPartitionBytes": str(size)}).items():
            spark.conf.set(name, value)

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("block", [4099, 1 << 20])
def test_counts_over_block_boundaries(spark, tmp_path, small_ranges, block):
    small_ranges(block)
    source = np.random.default_rng(block)
    files = {
        "a": source.integers(0, 4, 50), "b": np.array([0]), "c": np.array([5, 6]), "d": np.array([], int), "e": np.array([0, 0, 9, 0, 0]),
        "f": np.array([1] * 40), "g": np.array([1] * 20 + [0] + [2] * 21),
        # Zero bytes on both sides of the border of two ids, in all combinations.
        "h": source.choice([0, 1, 256, 0x1200, 0x12, 0xFF00], 30_000), "i": np.array([256] * 30 + [0, 256, 1, 256, 0, 0]),
    }
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(tokens.astype("<u2").tobytes())
    got = {}
    for r in count_tokens(spark, str(tmp_path)).orderBy("file", "ordinal").collect():
        got.setdefault(r.file[-1], []).append((r.ordinal, r.n_tokens))
    assert got == {n: list(enumerate(by_hand(t.tolist(), 0))) for n, t in files.items() if len(t)}


@pytest.mark.parametrize("size", [5001, 4098])
def test_wider_ids_and_bad_files(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    source = np.random.default_rng(size)
    ids = source.choice([70000, 99999, 0x86010000, 0x00009F86, 0x019F8601, 3], 9_000)
    (tmp_path / "a").write_bytes(ids.astype("<u4").tobytes())
    got = [r.n_tokens for r in count_tokens(spark, str(tmp_path), end=99999, width=4).orderBy("ordinal").collect()]
    assert got == by_hand(ids.tolist(), 99999)
    (tmp_path / "b").write_bytes(b"\1\2\3")
    with pytest.raises(ValueError, match="3 bytes"):
        count_tokens(spark, str(tmp_path))


def test_a_long_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    small_ranges(20_001)
    ids = np.random.default_rng(3).integers(0, 300, 200_000)
    (tmp_path / "a").write_bytes(ids.astype("<u2").tobytes())
    rows = count_tokens(spark, str(tmp_path)).select("ordinal", "n_tokens", F.spark_partition_id().alias("p")).collect()
    assert [r.n_tokens for r in sorted(rows, key=lambda r: r.ordinal)] == by_hand(ids.tolist(), 0)
    lines = spark.read.option("lineSep", "\0\0").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() >= 20


def test_written_files(spark, docs, wide_docs, no_docs, texts):
    path, buckets = write_token_files(docs, file_bytes=10_000)
    assert buckets > 3
    want = sorted(len((r.text or "").encode().split()) for r in docs.collect())
    assert sorted(r.n_tokens for r in count_tokens(spark, path).collect()) == want
    path, _ = write_token_files(wide_docs)
    assert count_tokens(spark, path).count() == wide_docs.count()
    path, buckets = write_token_files(no_docs)
    assert buckets == 1 and count_tokens(spark, path).collect() == []


def test_hot_ids_are_spread_over_files(spark):
    """Null and one id with most rows, exact repeats among them: no file gets long."""
    rows = [(None, "same words here " * 5)] * 300 + [(7, "w " * (i % 50)) for i in range(300)]
    rows += [(i, "a b c " * (i % 9)) for i in range(8, 200)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    path, buckets, hot = token_files(frame, file_bytes=4_000)
    assert sorted((r.key is None, r.key) for r in hot.collect()) == [(False, 7), (True, None)]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    assert files.agg(F.max("length")).first()[0] <= 12_000
    assert count_tokens(spark, path).count() == len(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = [tuple(r) for r in counted_in_files(frame, file_bytes=4_000).collect()]
    assert sorted(got, key=key) == sorted(((i, len(t.split())) for i, t in rows), key=key)
