"""Token counts: a separator scan over flat token files without an index.

A file is a row of token ids of fixed width; an end-of-document id closes each document.
Files are read in ranges, many tasks to a file, and searched for that id in blocks, as vectors. What
a block does not know, where it lies in the file, where the document at its start began and
how many ended before it, comes from prefix scans over the summaries of the file's blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.llm.common import broadcast_if_small, quoted, stored, text_slices, worker_state
from lakemark.session import fresh_path

#: Tokens are 16-bit, the first byte the lower one, and 0 ends a document.
WIDTH = 2
END_OF_DOCUMENT = 0
#: Different ids of the words of a text; the words are hashed to 1 .. WORD_IDS.
WORD_IDS = 65_535
#: Text of the documents whose tokens go to one file, about; tokens take less room.
FILE_BYTES = 32 << 20
REMEMBERED = 500_000


def word_tokens(text: str | None, known: dict[bytes, bytes]) -> bytes:
    """16-bit ids of the words between ASCII white space, by a hash of each word."""
    import xxhash

    words = (text or "").encode().split()
    found = list(map(known.get, words))
    if None in found:
        if len(known) > REMEMBERED:
            known.clear()
        for i, token in enumerate(found):
            if token is None:
                token = (xxhash.xxh3_64_intdigest(words[i]) % WORD_IDS + 1).to_bytes(WIDTH, "little")
                if len(words[i]) < 100:
                    known[words[i]] = token
                found[i] = token
    return b"".join(found)


def write_token_files(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> tuple[str, int]:
    """The folder and the number of buckets of ``token_files``."""
    return token_files(docs, doc_id, text, file_bytes)[:2]


def token_files(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES
) -> tuple[str, int, DataFrame]:
    """Write the word ids of every whole text to flat files in the shared folder.

    Returns the folder, the number of buckets, and (key, begin, parts) of the hot ids, those
    with the text of a file. Each file ``bucket=N/...`` with N below the number of buckets
    holds the documents of one bucket of the id's hash in ascending order of the id with
    null first. The documents of a hot id lie in ``parts`` files of their own from bucket
    ``begin`` on, dealt out in no order: they are of one id, so none is needed.
    A null text is an empty document.
    """
    spark = docs.sparkSession
    # A document of n bytes has (n + 1) / 2 words at most, so this bounds its part of a file.
    size = F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long") + 1 + WIDTH
    sizes = stored(docs.groupBy(quoted(doc_id).alias("key")).agg(F.sum(size).alias("size")), "id-sizes")
    buckets = (sizes.agg(F.sum("size")).first()[0] or 0) // file_bytes + 1
    hot = sizes.filter(F.col("size") > file_bytes).select("key", (F.floor(F.col("size") / file_bytes) + 1).alias("parts"))
    # At most one row for each file_bytes of text.
    before = Window.orderBy(F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    hot = stored(hot.select("key", (F.coalesce(F.sum("parts").over(before), F.lit(0)) + buckets).alias("begin"), "parts"), "hot-ids")
    extra = hot.agg(F.sum("parts")).first()[0] or 0
    rows = docs.select(quoted(doc_id).alias("key"), quoted(text).alias("text"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    if extra:
        # Exact repeats must part too, so the place of the row in its partition deals it out.
        rows = rows.withColumn("place", F.monotonically_increasing_id())
        rows = rows.join(broadcast_if_small(hot.withColumnRenamed("key", "of")), F.col("key").eqNullSafe(F.col("of")), "left")
        bucket = F.coalesce(F.col("begin") + F.pmod(F.xxhash64("place"), F.col("parts")), bucket)
    rows = rows.select(bucket.alias("bucket"), "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_state("word tokens", dict)
        for batch in text_slices(batches):
            tokens = [word_tokens(t, known) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("bucket"), batch.column("key"), pa.array(tokens, pa.binary())], ["bucket", "key", "tokens"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("tokens", T.BinaryType())])
    path = fresh_path(spark, "token-files")
    # The text writer puts the bytes of a string as they are, and the separator, two zero
    # bytes, behind each row: the end-of-document id.
    (
        rows.mapInArrow(run, schema)
        .repartition(max(1, min(buckets + extra, int(spark.conf.get("spark.sql.shuffle.partitions")))), "bucket")
        .sortWithinPartitions("bucket", F.col("key").asc_nulls_first())
        .select("bucket", F.col("tokens").cast("string").alias("value"))
        .write.partitionBy("bucket").option("lineSep", "\0" * WIDTH).option("maxRecordsPerFile", 0).text(path)
    )
    return path, buckets, hot


def counted_in_files(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """(id, n_tokens) of every document, counted in ``token_files`` of all of them.

    The files know no document ids: the order within a bucket gives them back, or for a hot
    id the bucket alone.
    """
    path, buckets, hot = token_files(docs, doc_id, text, file_bytes)
    bucket = F.regexp_extract("file", r"/bucket=(\d+)/", 1).cast("long")
    counts = count_tokens(docs.sparkSession, path).select(bucket.alias("bucket"), "ordinal", "n_tokens")
    ids = docs.select(quoted(doc_id).alias("key"))
    some = bool(hot.head(1))
    if some:
        of = broadcast_if_small(hot.select(F.col("key").alias("of")))
        ids = ids.join(of, F.col("key").eqNullSafe(F.col("of")), "left_anti")
    ids = ids.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    within = Window.partitionBy("bucket").orderBy(F.col("key").asc_nulls_first())
    ids = ids.withColumn("ordinal", (F.row_number().over(within) - 1).cast("long"))
    found = ids.join(counts, ["bucket", "ordinal"]).select(F.col("key").alias("id"), "n_tokens")
    if some:
        own = F.explode(F.sequence("begin", F.col("begin") + F.col("parts") - 1))
        own = broadcast_if_small(stored(hot.select(F.col("key").alias("id"), own.alias("bucket")), "hot-buckets"))
        found = found.unionByName(counts.filter(F.col("bucket") >= buckets).join(own, "bucket").select("id", "n_tokens"))
    return found


def count_tokens(spark: SparkSession, path: str, end: int = END_OF_DOCUMENT, width: int = WIDTH) -> DataFrame:
    """(file, ordinal, n_tokens): the documents of each flat token file below ``path`` in
    order from 0, with the number of tokens before their end-of-document id.

    Tokens behind the last such id are a last document; a document may be empty. An empty
    file has none. A file that is no whole number of ids long fails. Files of any length are
    read in the session's ranges (``spark.sql.files.maxPartitionBytes``), each a task.

    The reader cuts a file at one byte of that id wherever it lies, so what it gives, and that byte
    again, are the bytes of the file. A first scan adds up the bytes of every range, which says
    where each begins; a second finds the ids among the whole tokens. Bytes of a token that
    lies across ranges are put together by its place.
    """
    mark = end.to_bytes(width, "little")
    cut = bytes([max(mark)])
    reader = spark.read.options(lineSep=cut.decode("latin-1"), encoding="ISO-8859-1", recursiveFileLookup="true")
    place = [F.col(f"_metadata.{name}") for name in ("file_path", "file_block_start", "file_size")]
    rows = reader.text(path).select(*[c.alias(n) for c, n in zip(place, ("file", "range", "size"))], F.col("value").cast("binary").alias("value"))
    ranges = rows.groupBy("file", "range", "size").agg(F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("bytes"))
    ranges = stored(ranges, "token-ranges")
    bad = ranges.filter(F.col("size") % width != 0).select("file", "size").first()
    if bad:
        raise ValueError(f"{bad['file']}: {bad['size']} bytes; expected whole ids of {width} bytes")
    # A row for each range.
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored(ranges.select("file", "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")), "token-starts")
    placed = rows.join(broadcast_if_small(ranges), ["file", "range"]).select("file", "range", "start", "size", "value")
    names = ["file", "first", "last", "piece", "ends"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The range that is being read, the place of its next byte, and the bytes of a token begun.
        key, at, begun = None, 0, b""
        for batch in batches:
            files, firsts = batch.column("file").to_pylist(), batch.column("range").to_pylist()
            values = batch.column("value")
            edges = [i for i in range(1, len(files)) if (files[i], firsts[i]) != (files[i - 1], firsts[i - 1])]
            out = []
            for a, b in zip([0, *edges], [*edges, len(files)]):
                if (files[a], firsts[a]) != key:
                    if begun:
                        out.append((key[0], at - len(begun), at, begun, []))
                    key, at, begun = (files[a], firsts[a]), batch.column("start")[a].as_py(), b""
                data = cut.join([*values[a:b].to_pylist(), b""])
                # Behind the last bytes of a file there is no cut.
                data = data[: max(batch.column("size")[a].as_py() - at, 0)]
                if not begun and at % width:
                    head = min(-at % width, len(data))
                    out.append((files[a], at, at + head, data[:head], []))
                    at, data = at + head, data[head:]
                    if at % width:
                        continue
                data, at = begun + data, at - len(begun)
                whole = len(data) // width * width
                ends = np.flatnonzero(np.frombuffer(data, dtype=f"<u{width}", count=whole // width) == end) + at // width
                if whole:
                    out.append((files[a], at, at + whole, None, ends))
                at, begun = at + len(data), data[whole:]
            yield pa.record_batch([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names)
        if begun:
            last = (key[0], at - len(begun), at, begun, [])
            yield pa.record_batch([pa.array([x], kind) for x, kind in zip(last, kinds)], names)

    # A range's lines come to one task in their order, as they lie in the file.
    found = stored(placed.mapInArrow(scan, "file string, first long, last long, piece binary, ends array<long>"), "token-blocks")
    # Tokens across ranges: a few rows for each range. The last piece has the id they make.
    pieces = found.filter(F.col("piece").isNotNull()).groupBy("file", F.floor(F.col("first") / width).alias("token"))
    whole = F.aggregate(F.array_sort(F.collect_list(F.struct("first", "piece"))), F.lit(b""), lambda x, y: F.concat(x, y["piece"]))
    across = pieces.agg(F.max("first").alias("first"), whole.alias("whole")).filter(F.col("whole") == F.lit(mark))
    across = broadcast_if_small(stored(across.select("file", "first", "token"), "token-pieces"))
    found = found.join(across, ["file", "first"], "left")
    ends = F.when(F.col("piece").isNotNull() & F.col("token").isNotNull(), F.array("token")).otherwise(F.col("ends"))
    found = found.withColumn("ends", ends).select("file", "first", "last", "ends")
    # The scan over blocks: a row for each, without the ends it found.
    order = Window.partitionBy("file").orderBy("first")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    last_end = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    blocks = found.select("file", "first", "last", F.size("ends").alias("n"), last_end.alias("last_end"))
    blocks = blocks.select(
        "file", "first", (F.col("last") / width).cast("long").alias("tokens"), F.lead("first").over(order).isNull().alias("closes"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("done"), F.coalesce(F.max("last_end").over(earlier), F.lit(-1)).alias("open"),
    )
    found = found.select("file", "first", "ends").join(broadcast_if_small(stored(blocks, "token-scan")), ["file", "first"])
    # Behind the last block of a file a missing end is added.
    closed = F.coalesce(last_end, F.col("open")) == F.col("tokens") - 1
    ends = F.when(~F.col("closes") | closed, F.col("ends")).otherwise(F.concat("ends", F.array("tokens")))
    lengths = F.transform(
        F.col("ends"), lambda e, i: e - F.when(i == 0, F.col("open")).otherwise(F.get(F.col("ends"), i - 1)) - 1
    )
    found = found.withColumn("ends", ends).select("file", "done", lengths.alias("lengths"))
    one = found.select("file", "done", F.posexplode("lengths").alias("at", "n_tokens"))
    return one.select("file", (F.col("done") + F.col("at")).alias("ordinal"), "n_tokens")
