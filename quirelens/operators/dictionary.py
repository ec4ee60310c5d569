"""Dictionary membership: exact, and by a Bloom filter kept as a table of bit words."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.operators.lookup import fits_broadcast, flag_members
from quirelens.settings import BLOOM_FPP

WORD_BITS = 32
MAX_BLOOM_BYTES = 8 << 20


def in_dictionary(rows: DataFrame, dictionary: DataFrame, column: str = "term", small: bool | None = None) -> DataFrame:
    """Rows whose ``column`` is a dictionary word."""
    words = dictionary.select(F.col("word").alias(column)).distinct()
    if fits_broadcast(words) if small is None else small:
        return rows.join(F.broadcast(words), column, "left_semi")
    return flag_members(rows, dictionary, column, "_known", False).filter("_known").drop("_known")


def bloom_shape(n_words: int, fpp: float = BLOOM_FPP) -> tuple[int, int]:
    """(bits, hash positions per word) for ``n_words`` at the given false-positive rate."""
    bits = max(WORD_BITS, math.ceil(-n_words * math.log(fpp) / math.log(2) ** 2))
    return bits, max(1, round(bits / max(n_words, 1) * math.log(2)))


def _positions(word: Column, bits: Column | int, hashes: int) -> Column:
    """``hashes`` bit positions of a word, from slices of salted digests."""
    places = []
    for k in range(1, hashes + 1):
        digest = F.substr(F.md5(F.concat(F.lit(f"{k}:"), word)), F.lit(1), F.lit(8))
        places.append(F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(bits).cast("bigint")))
    return F.array(*places)


def bloom_build(dictionary: DataFrame, fpp: float = BLOOM_FPP, n_words: int | None = None) -> DataFrame:
    """(word_index, bits, n_bits, n_hashes): the set bits, 32 to a word, with the filter's shape."""
    words = dictionary.select("word").distinct()
    bits, hashes = bloom_shape(words.count() if n_words is None else n_words, fpp)
    return (
        words.select(F.explode(_positions(F.col("word"), bits, hashes)).alias("p"))
        .select(
            F.floor(F.col("p") / WORD_BITS).alias("word_index"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("p", F.lit(WORD_BITS)).cast("int")).alias("bit"),
        )
        .groupBy("word_index")
        .agg(F.bit_or("bit").alias("bits"))
        .select("word_index", "bits", F.lit(bits).cast("bigint").alias("n_bits"), F.lit(hashes).alias("n_hashes"))
    )


def bloom_probe(rows: DataFrame, bloom: DataFrame, column: str = "term", max_bytes: int = MAX_BLOOM_BYTES) -> DataFrame:
    """Rows with ``might_contain``. The bits are packed into one constant and tested in the row: no distinct, no join.

    A filter of more than ``max_bytes`` is refused; exact membership (``in_dictionary``) is the way for such a dictionary.
    """
    shape = bloom.select("n_bits", "n_hashes").first()
    if shape is None:
        return rows.withColumn("might_contain", F.lit(False))
    n_words = -(-shape["n_bits"] // WORD_BITS)
    if n_words * WORD_BITS // 8 > max_bytes:
        raise ValueError(f"a filter of {n_words * WORD_BITS // 8} bytes is more than the {max_bytes} that may be sent")
    packed = bytearray(n_words * WORD_BITS // 8)
    for word in bloom.select("word_index", "bits").collect():  # no more than max_bytes
        packed[word["word_index"] * 4:word["word_index"] * 4 + 4] = (word["bits"] & 0xFFFFFFFF).to_bytes(4, "little")
    bits = F.lit(bytes(packed))

    def is_set(p: Column) -> Column:
        byte = F.conv(F.hex(F.substr(bits, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, F.pmod(p, F.lit(8)).cast("int")) % 2 == 1

    places = _positions(F.col(column), shape["n_bits"], shape["n_hashes"])
    return rows.withColumn("might_contain", F.coalesce(F.forall(places, is_set), F.lit(False)))


def _fingerprint(words: DataFrame) -> dict[str, int]:
    """What tells a set of words from others, in any order: its size and two digests over all of them."""
    seen = words.select("word").distinct().agg(
        F.count(F.lit(1)).alias("n_words"),
        F.coalesce(F.bit_xor(F.xxhash64("word")), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(F.crc32("word")), F.lit(0)).alias("summed"),
    )
    return seen.first().asDict()


def _shape_of(bloom: DataFrame) -> dict[str, int | None]:
    """What a table of bit words holds, as one row of numbers."""
    place = F.xxhash64("word_index", "bits")
    return bloom.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(place).alias("places"), F.max("n_bits").alias("n_bits"), F.max("n_hashes").alias("n_hashes")).first().asDict()


def _manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests below a filter's folder, oldest first; none where nothing was published."""
    try:
        lines = spark.read.text(f"{path}/manifests", recursiveFileLookup=True).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(line["value"]) for line in lines), key=lambda m: m["version"])


def bloom_load_or_build(spark: SparkSession, path: str, dictionary: DataFrame, fpp: float = BLOOM_FPP) -> DataFrame:
    """The filter of a dictionary, saved at ``path``; built and saved there first where it is not.

    A filter is written to a folder of its own, and counts once a manifest names it, with the fingerprint of the words it
    was built from, its rate, and what its rows hold. So a filter that was written in part, was built from other
    words or at another rate, or has lost rows since, is not used but built again.
    """
    path = path.rstrip("/")
    wanted = {**_fingerprint(dictionary), "fpp": fpp}
    published = _manifests(spark, path)
    for manifest in reversed(published):
        if all(manifest[k] == v for k, v in wanted.items()):
            try:
                saved = spark.read.parquet(f"{path}/{manifest['folder']}")
                if _shape_of(saved) == manifest["shape"]:
                    return saved
            except AnalysisException as lost:  # the folder went, or holds no file that tells its columns
                if lost.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
    version = published[-1]["version"] + 1 if published else 1
    folder = f"bits-{uuid.uuid4().hex}"
    bloom_build(dictionary, fpp, wanted["n_words"]).write.parquet(f"{path}/{folder}")
    saved = spark.read.parquet(f"{path}/{folder}")
    manifest = {**wanted, "version": version, "folder": folder, "shape": _shape_of(saved)}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifests/{folder}")
    return saved


def expand_dictionary(dictionary: DataFrame) -> DataFrame:
    """Every word 26 times, with each of the letters a to z put in front."""
    letters = F.array(*[F.lit(chr(c)) for c in range(ord("a"), ord("z") + 1)])
    return dictionary.select(F.explode(letters).alias("letter"), "word").select(F.concat("letter", "word").alias("word"))
