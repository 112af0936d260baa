"""Collocations: phrases of two to five words, by language, mined best first.

A phrase with f occurrences among n words is scored at each cut into a first part (l occurrences) and
a rest (r): 1000 * f * n / (l * r), rounded down. Its lowest cut counts.

Bounds. Neither part of a phrase is rarer than the phrase, so the score of every phrase that grows from
a prefix p is at most 1000 * n / f(p's first word), and in the same way at most 1000 * n / f(last word).
The frontier is therefore ordered by the frequency of words: prefixes that begin with rarer words come
first. A round opens the frontier down to a bound: phrases whose first and last word have at most `upto`
occurrences are settled with their scores. It ends for a language once its `first`-th surviving score
lies above the bound of all that is still closed, so ties are in; else the next round opens what that
score still allows, or `GROWTH` times as much while there are too few phrases.

Growth. A round counts pairs of words first and then longer phrases, and a phrase grows only over pairs
that occur often enough. Words and pairs that do are bitmaps of hashes of a bounded size. What a bitmap
lets through by chance is counted as well and then dropped by its exact count: no result depends on it.
All phrases that begin or end with an open word are counted, so prefixes and rests of settled phrases
have exact counts, and so have their extensions by a word. A phrase is left out if a longer one with as
many occurrences contains it; then an extension by one word has as many too.

Texts are read once: they become rows of word codes with the words of the row beside them, which all
rounds read. Counts are folded by row before the shuffle and partially before it again, so a word,
passage or line that is everywhere brings one row a task. A long text is several rows; each repeats the
last words of the one before as context, so no phrase is lost or counted twice.

Defined results: a NULL text is empty; a NULL language is `und`, as is the language of that name; blank
texts have no words; repeated rows count each; ties go by score, count and phrase in order of bytes; a
language with fewer phrases gives them all; an empty table gives an empty result; further columns are
ignored. Counts are 64-bit, products 38-digit decimals.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake.llm.shared import Workspace, prepare, required

LEAST, LONGEST, FIRST = 100, 5, 2000
OPEN_AT_FIRST, GROWTH = 16, 16
SLICE = 2 * 1024**2  # bytes of text to a row of codes
ROWS_PER_FILE = 16
BITS_PER_KEY, MAX_BITS = 16, 1 << 27  # 16 MB a bitmap at most

# Capitals to lower, ends of pieces to a full stop, tabs to blanks.
_CAPITALS, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_CAPITALS + _ENDS + b"\t", _CAPITALS.lower() + b"." * len(_ENDS) + b" ")
_GAP = re.compile(rb"[ .]")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_CODED = "lang string, context int, codes binary, words array<string>, counts array<long>"


def _slices(data: bytes):
    """Words of the data, full stops between pieces, cut at words into slices."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + SLICE)
        end = gap.start() if gap else len(data)
        yield data[at:end].replace(b".", b" . ").split()
        at = end


def _coded(batches):
    """Rows of codes by language: -1 between pieces, else the index into the row's words."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            tail: list[bytes] = []
            for words in _slices(b".".join(texts).translate(_PLAIN)):
                words = tail + words
                context, tail = len(tail), words[1 - LONGEST :]
                found = pa.array(words, pa.binary()).dictionary_encode()
                codes, known = found.indices.to_numpy(), found.dictionary
                stop = known.index(b".").as_py()
                if stop >= 0:
                    codes = np.where(codes == stop, -1, codes - (codes > stop)).astype(np.int32)
                    known = pa.concat_arrays([known[:stop], known[stop + 1 :]])
                fresh = codes[context:]
                counts = np.bincount(fresh[fresh >= 0], minlength=len(known))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]), pa.array([context], pa.int32()), pa.array([codes.tobytes()], pa.binary()),
                        pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known.cast(pa.string())),
                        pa.array([counts], pa.list_(pa.int64())),
                    ],
                    names=["lang", "context", "codes", "words", "counts"],
                )


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a * _M1 ^ b) * _M2
    return mixed ^ (mixed >> np.uint64(29))


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes % np.uint64(8 * len(bitmap))
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


class _Row:
    """A row of codes with what the bitmaps say of its words."""

    def __init__(self, batch, i: int, often, opened):
        self.context = batch.column(1)[i].as_py()
        self.codes = np.frombuffer(batch.column(2)[i].as_buffer(), np.int32)
        self.words = batch.column(3)[i].values
        self.hashes = batch.column(4)[i].values.to_numpy().view(np.uint64)
        none = np.zeros(1, bool)  # of the ends of pieces, whose code is -1
        self.often = np.append(_has(often, self.hashes), none)[self.codes]
        self.open = self.often & np.append(_has(opened, self.hashes), none)[self.codes]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each position: both words occur often; and one of the two is open."""
        both = self.often[:-1] & self.often[1:]
        return both, both & (self.open[:-1] | self.open[1:])

    def counted(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases from the positions that end in this row: a position of each, and counts."""
        at = at[at + length > self.context]
        key = self.codes[at].astype(np.int64)
        for k in range(1, length):
            key = key * (len(self.words) + 1) + self.codes[at + k]
            if k < length - 1:
                key = np.unique(key, return_inverse=True)[1]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return at[first], counts

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.codes[at + k])) for k in range(length)]
        return pc.binary_join_element_wise(*parts, " ")


def _count_pairs(often, opened):
    names = ["lang", "phrase", "hash", "f"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = _Row(batch, i, often.value, opened.value)
                at, counts = row.counted(np.flatnonzero(row.pairs()[1]), 2)
                hashes = _pair_hash(row.hashes[row.codes[at]], row.hashes[row.codes[at + 1]]).view(np.int64)
                lang = pa.repeat(batch.column(0)[i], len(at))
                yield pa.RecordBatch.from_arrays(
                    [lang, row.phrases(at, 2), pa.array(hashes), pa.array(counts.astype(np.int64))], names=names
                )

    return run


def _count_longer(often, opened, pairs, longest: int):
    """Phrases of three words and more; a pair with an open word is crossed only if it occurs often."""
    names = ["lang", "phrase", "f"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = _Row(batch, i, often.value, opened.value)
                way, known = row.pairs()
                at = np.flatnonzero(known)
                hashes = _pair_hash(row.hashes[row.codes[at]], row.hashes[row.codes[at + 1]])
                way[at[~_has(pairs.value, hashes)]] = False
                grown = way
                for length in range(3, longest + 1):
                    if len(grown) < 2:
                        break
                    grown = grown[:-1] & way[length - 2 :]
                    ends = row.open[: len(grown)] | row.open[length - 1 : length - 1 + len(grown)]
                    at, counts = row.counted(np.flatnonzero(grown & ends), length)
                    lang = pa.repeat(batch.column(0)[i], len(at))
                    yield pa.RecordBatch.from_arrays(
                        [lang, row.phrases(at, length), pa.array(counts.astype(np.int64))], names=names
                    )

    return run


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value of column `hash`; at most `bits` bits, whatever their number."""
    slot = F.pmod(F.col("hash"), F.lit(bits)) + 1
    if bits & (bits - 1):
        raise ValueError("bits must be a power of two, so that signed and unsigned remainders agree")
    out = np.zeros(bits // 8, np.uint8)
    parts = hashes.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    for row in parts.collect():  # at most bits / 2^15 rows of 4 KB
        begin = 4096 * (row["part"] - 1)
        out[begin : begin + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)[: len(out) - begin]
    return out


def _bits_for(keys: int) -> int:
    return min(MAX_BITS, 1 << max(15, (BITS_PER_KEY * max(keys, 1) - 1).bit_length()))


def _scored(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """Settled phrases (lang, phrase, a, l, r, n, score) with their lowest cut, of (lang, phrase, f).

    Cuts meet counts in two joins of tables, which adaptive execution splits at common first words.
    """
    words = F.split("phrase", " ")
    cuts = counts.filter(F.instr("phrase", " ") > 0).select(
        "lang", "phrase", F.col("f").alias("a"), words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", (F.col("k") == F.size("words") - 1).alias("at_last"),
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    met = cuts.join(left, ["lang", "left"], "left").join(right, ["lang", "right"], "left")
    met = met.join(limits.select("lang", "n", "upto"), "lang")
    score = F.expr(
        "(cast(1000 * a AS decimal(19,0)) * cast(n AS decimal(19,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    open_ends = F.bool_and(
        F.when(F.col("k") == 1, F.coalesce(F.col("l") <= F.col("upto"), F.lit(False))).otherwise(True)
        & F.when(F.col("at_last"), F.coalesce(F.col("r") <= F.col("upto"), F.lit(False))).otherwise(True)
    )
    settled = met.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), lowest.alias("cut"), open_ends.alias("settled")
    )
    return settled.filter("settled").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _contained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a): phrases that a phrase of one word more contains at each of its a places."""
    words = F.split("phrase", " ")
    longer = counts.select("lang", words.alias("words"), F.col("f").alias("a")).filter(F.size("words") > 2)
    parts = F.explode(F.array(*[F.slice("words", at, F.size("words") - 1) for at in (1, 2)]))
    return longer.select("lang", parts.alias("part"), "a").select("lang", F.array_join("part", " ").alias("phrase"), "a")


def mine(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST,
    text_column: str = "text", lang_column: str = "lang", max_bits: int = MAX_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `first` highest-scoring phrases."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    prepare(spark)
    space = Workspace(spark, "collocations")
    texts = required(docs, lang_column, text_column).select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = T.StructType.fromDDL(_CODED)
    (
        texts.mapInArrow(_coded, schema).write.option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE).parquet(space.path("coded"))
    )
    coded = space.get("coded", schema)
    one = F.explode(F.arrays_zip("words", "counts")).alias("x")
    words = space.put(
        "words",
        coded.select("lang", one).groupBy("lang", F.col("x.words").alias("phrase")).agg(F.sum("x.counts").alias("f"))
        .filter(F.col("f") >= least),
    )
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)
    limits = space.put(
        "limits-0",
        coded.groupBy("lang").agg(F.sum(total).alias("n"))
        .join(words.groupBy("lang").agg(F.max("f").alias("most")), "lang")
        .withColumn("upto", F.least("most", F.lit(OPEN_AT_FIRST * least).cast("long"))),
    )
    hashed = coded.select(
        "lang", "context", "codes", "words", F.transform("words", lambda w: F.xxhash64(F.col("lang"), w)).alias("hashes")
    )
    answers, turn = [], 0
    while not limits.isEmpty():
        found = space.put(f"found-{turn}", _round(hashed, words, limits, space, turn, least, longest, first, max_bits))
        last = found.filter(F.col("rank") == first).select("lang", F.col("score").alias("enough"))
        closed_bound = F.expr("(1000 * n) div (upto + 1)")
        judged = limits.join(last, "lang", "left").select(
            "lang", "n", "most", "upto", "enough",
            ((F.col("upto") >= F.col("most")) | F.coalesce(closed_bound < F.col("enough"), F.lit(False))).alias("settled"),
        )
        judged = space.put(f"judged-{turn}", judged)
        answers.append(found.join(judged.filter("settled").select("lang"), "lang", "left_semi"))
        wanted = F.when(
            F.col("enough").isNotNull(),
            F.greatest(F.expr("(1000 * n) div greatest(enough, 1)"), F.col("upto") + 1),
        ).otherwise(GROWTH * F.col("upto"))
        turn += 1
        limits = space.put(f"limits-{turn}", judged.filter("NOT settled").select(
            "lang", "n", "most", F.least("most", wanted).cast("long").alias("upto")
        ))
        space.release()
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if not answers:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    out = answers[0]
    for more in answers[1:]:
        out = out.unionByName(more)
    return out.select(*columns)


def _round(hashed, words, limits, space, turn, least, longest, first, max_bits) -> DataFrame:
    """The best settled phrases of the languages in `limits`, opened up to their limits.

    Rows of other languages are read too, but have no word in the bitmaps.
    """
    spark = words.sparkSession
    sc = spark.sparkContext
    known = words.join(limits, "lang").select("lang", "phrase", "f", "upto", F.xxhash64("lang", "phrase").alias("hash"))
    bits = min(max_bits, _bits_for(known.count()))
    often = sc.broadcast(_bitmap(known.select("hash"), bits))
    opened = sc.broadcast(_bitmap(known.filter(F.col("f") <= F.col("upto")).select("hash"), bits))
    pairs = space.put(
        f"pairs-{turn}",
        hashed.mapInArrow(_count_pairs(often, opened), "lang string, phrase string, hash long, f long")
        .groupBy("lang", "phrase").agg(F.first("hash").alias("hash"), F.sum("f").alias("f"))
        .filter(F.col("f") >= least),
    )
    counts = words.join(limits.select("lang"), "lang", "left_semi").unionByName(pairs.drop("hash"))
    if longest > 2:
        crossed = sc.broadcast(_bitmap(pairs.select("hash"), min(max_bits, _bits_for(pairs.count()))))
        longer = hashed.mapInArrow(
            _count_longer(often, opened, crossed, longest), "lang string, phrase string, f long"
        ).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        counts = counts.unionByName(longer)
    counts = space.put(f"counts-{turn}", counts)
    kept = _scored(counts, limits).join(_contained(counts), ["lang", "phrase", "a"], "left_anti")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= first).withColumn(
        "rank", F.col("rank").cast("long")
    )
