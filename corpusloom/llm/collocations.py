"""Phrase collocations: n-grams of words counted in counting quotient filters, scored by their weakest cut.

Texts are read once, block by block (a few MB), into numbers of the block's own word list. The lists are counted as rows;
words that are frequent enough get an id in all the corpus (a phrase is never more frequent than its words, so no other
word is in a candidate). Each block then packs its n-grams of ids into counting quotient filters, cut by leading bits into
shards, and a shard's filters are merged as sorted lists. Where that takes very many shards, merging goes in rounds: sets
of blocks first, by few bits, then fewer and larger filters by more bits. So no task holds more than a shard's share,
and a phrase with a third of all occurrences is one entry per block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.quotient import LONGEST, Filter, id_bits, pack, permute, restore, unpack
from corpusloom.session import discard, materialize

NO_GROUP = "und"
#: Bytes of text per block, and the occurrences that a shard's filters may hold on average.
BLOCK, SHARD = 8 << 20, 1 << 20
#: A round of merging cuts by so many bits, and (but for the last) merges the filters of so many sets of blocks apart.
ROUND_BITS, FAN = 8, 64
_BUCKETS = 4096
_SALTS = 64
# the byte that stands for the end of a piece: it is in no UTF-8 text
_END = 0xFF
_SPLIT = bytes(_END if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_PIECE_END = re.compile(rb"[.,;:!?\n-\r]")
_CODES = pa.schema([
    ("block", pa.int64()), ("grp", pa.string()), ("pos", pa.int32()), ("word", pa.string()), ("n", pa.int64()),
    ("codes", pa.binary()),
])
_CODE_ROWS = "block long, grp string, pos int, word string, n long, codes binary"


class _Numbers(dict):
    """Numbers words in order of first appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({bytes([_END]): 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    """Texts of one group: the numbers of their words, piece after piece."""

    def __init__(self):
        self.numbers, self.codes, self.size = _Numbers(), [], 0

    def add(self, text: bytes) -> None:
        words = text.lower().translate(_SPLIT).replace(b"\xff", b" \xff ")
        # split() also splits at the white space that ends pieces, none of which is left
        codes = list(map(self.numbers.__getitem__, words.split()))
        codes.append(0)
        self.codes.append(np.array(codes, np.uint32))
        self.size += len(text)

    def rows(self, block: int, group: str) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(self.codes)
        words = list(self.numbers)[1:]
        counts = np.bincount(codes, minlength=len(words) + 1)
        packed = pa.compress(codes.tobytes(), codec="zstd", asbytes=True)
        yield pa.RecordBatch.from_pylist(
            [{"block": block, "grp": group, "pos": 0, "n": int(counts[1:].sum()), "codes": len(codes).to_bytes(8, "little") + packed}],
            _CODES,
        )
        for i in range(0, len(words), 50_000):
            part = pa.array(words[i : i + 50_000], pa.binary()).cast(pa.string())
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block)), pa.array([group] * n, pa.string()),
                    pa.array(np.arange(i + 1, i + 1 + n, dtype=np.int32)), part, pa.array(counts[i + 1 : i + 1 + n]),
                    pa.nulls(n, pa.binary()),
                ],
                schema=_CODES,
            )


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """A very long text in parts that end with a piece."""
    start = 0
    while len(text) - start > size and (cut := _PIECE_END.search(text, start + size)):
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def read_blocks(docs: DataFrame, text: str, group: str, size: int = BLOCK) -> DataFrame:
    """Rows of two kinds. ``pos`` 0: a block's ``codes`` and its number of words ``n``. Others: a word of the block, its
    number ``pos`` and its count ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        blocks: dict[str, _Block] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in _slices(body.as_py(), size):
                    block = blocks.setdefault(name, _Block())
                    block.add(part)
                    if block.size >= size:
                        yield from blocks.pop(name).rows(first + made, name)
                        made += 1
        for name, block in blocks.items():
            yield from block.rows(first + made, name)
            made += 1

    rows = docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("grp"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )
    return rows.where(F.octet_length("body") > 0).mapInArrow(run, _CODE_ROWS)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id`` from 1, without a gap: rows are numbered within hash buckets, and only the buckets' sizes
    are added up in one place."""
    rows = words.withColumn("bucket", F.expr(f"pmod(xxhash64(grp, word), {_BUCKETS})"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(W.partitionBy("bucket").orderBy("grp", "word"))
    return rows.join(sizes.select("bucket", before.alias("before")), "bucket").select(
        "grp", "word", "f", (F.col("before") + within).cast("long").alias("id")
    )


def _block_filters(ids: np.ndarray, bits: int) -> Iterator[tuple[int, Filter]]:
    """The n-grams of one block, ``ids`` being 0 where a piece ends and for words that are too rare."""
    whole = ids != 0
    for n in range(2, LONGEST + 1):
        if len(ids) < n:
            return
        whole = whole[: len(ids) - n + 1] & (ids[n - 1 :] != 0)
        at = np.flatnonzero(whole)
        if not len(at):
            return
        half = n * bits // 2
        left, right = permute(*pack([ids[at + k] for k in range(n)], bits), half)
        yield n, Filter.of(half, left, right)


_FILTERS = pa.schema([("n", pa.int32()), ("prefix", pa.int64()), ("salt", pa.int64()), ("filter", pa.binary())])
_FILTER_ROWS = "n int, prefix long, salt long, filter binary"


def _shards(n: int, whole: Filter, cut: int, salt: int) -> list[dict]:
    cut = min(cut, whole.half)
    return [{"n": n, "prefix": p, "salt": salt, "filter": f.dump(cut)} for p, f in whole.split(cut)]


def count_phrases(blocks: DataFrame, ids: DataFrame, least: int, shard: int, round_bits: int) -> DataFrame:
    """``n``, ``ids`` (array) and ``f`` of every n-gram of 2 to 4 words that occurs ``least`` times."""
    totals = ids.agg(F.max("id").alias("top"), F.sum("f").alias("f")).first()
    bits = id_bits(totals.top or 1)
    cut = max(0, math.ceil(math.log2(max(1, (totals.f or 0) / shard))))
    rounds = max(1, math.ceil(cut / round_bits))
    cuts = [round(cut * (i + 1) / rounds) for i in range(rounds)]

    def encode(key: tuple, code_rows: pa.Table, word_rows: pa.Table) -> pa.Table:
        rows = []
        for block, packed in zip(code_rows.column("block").to_pylist(), code_rows.column("codes"), strict=True):
            blob = packed.as_py()
            size = int.from_bytes(blob[:8], "little")
            codes = np.frombuffer(pa.decompress(blob[8:], size * 4, codec="zstd"), np.uint32)
            own = np.zeros(int(codes.max()) + 1, np.uint64)
            own[word_rows.column("pos").to_numpy()] = word_rows.column("id").to_numpy().astype(np.uint64)
            for n, whole in _block_filters(own[codes], bits):
                rows += _shards(n, whole, cuts[0], block % FAN)
        return pa.Table.from_pylist(rows, _FILTERS)

    def loaded(key: tuple, table: pa.Table) -> Filter:
        prefix = key[1].as_py()
        return Filter.merged([Filter.load(x.as_py(), prefix) for x in table.column("filter")])

    def narrower(cut: int):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            # fewer salts in each round, so that the last one meets filters of few, large sets of blocks
            return pa.Table.from_pylist(_shards(key[0].as_py(), loaded(key, table), cut, key[2].as_py() // 8), _FILTERS)

        return run

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        n, whole = key[0].as_py(), loaded(key, table)
        often = whole.count >= least
        words = unpack(*restore(whole.left[often], whole.right[often], whole.half), n, bits)
        flat = np.stack(words, axis=1).astype(np.int64).ravel()
        size = int(often.sum())
        return pa.table({
            "n": pa.array(np.full(size, n, np.int32)),
            "ids": pa.ListArray.from_arrays(np.arange(0, size * n + 1, n, dtype=np.int32), flat),
            "f": pa.array(whole.count[often].astype(np.int64)),
        })

    codes = blocks.where("pos = 0").select("block", "codes").groupBy("block")
    known = blocks.where("pos > 0").select("block", "pos", "grp", "word").join(ids.select("grp", "word", "id"), ["grp", "word"])
    filters = codes.cogroup(known.select(F.col("block").alias("of"), "pos", "id").groupBy("of")).applyInArrow(encode, _FILTER_ROWS)
    for cut in cuts[1:]:
        filters = filters.groupBy("n", "prefix", "salt").applyInArrow(narrower(cut), _FILTER_ROWS)
    return filters.groupBy("n", "prefix").applyInArrow(finish, "n int, ids array<long>, f long")


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def score(phrases: DataFrame, words: DataFrame, cover: float) -> DataFrame:
    """``ids``, ``a`` and the lowest-scoring cut (``score``, ``k``, ``l``, ``r``) of the phrases that no longer one
    covers. ``words``: ``id`` and ``f`` of the single words."""
    known = phrases.select("ids", "f").union(words.select(F.array("id").alias("ids"), "f"))
    n = F.size("ids")
    cuts = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), n - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, n - F.col("k")).alias("tail")
    )
    cuts = cuts.join(known.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(known.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    value = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    weakest = cuts.groupBy("ids").agg(
        F.max("a").alias("a"), F.min(F.struct(value.cast("long").alias("score"), "k", "l", "r")).alias("cut")
    )
    parts = [(i, m) for size in range(3, LONGEST + 1) for m in range(2, size) for i in range(size - m + 1)]
    inner = F.filter(
        F.array(*[F.when(n >= i + m, F.slice("ids", i + 1, m)) for i, m in sorted(set(parts))]),
        lambda part: part.isNotNull() & (F.size(part) < n),
    )
    longer = phrases.where("n > 2").select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("most"))
    free = F.col("most").isNull() | (_exact(F.col("most")) * 100 < _exact(F.col("a")) * F.lit(cover).cast("int"))
    return weakest.join(longer, "ids", "left").where(free).select("ids", "a", "cut.*")


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    least: int = 30,
    top: int = 2000,
    cover: int = 80,
    block: int = BLOCK,
    shard: int = SHARD,
    round_bits: int = ROUND_BITS,
) -> DataFrame:
    """The ``top`` phrases of each group: ``group``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the
    group) and ``score``.

    ASCII capitals are lowered; pieces end at ``.,;:!?``, line feeds, vertical tabs, form feeds and returns, words at
    spaces and tabs. Phrases of 2 to 4 words with at least ``least`` occurrences in a piece are candidates; one whose words
    stand in a longer candidate with ``cover`` per cent of its occurrences or more is dropped. Everything is per group;
    a null group is ``und``. Null and empty texts have no words, repeated rows count as often as they are there. Ties of
    scores go by occurrences, then by phrase in byte order. An empty table gives no rows; other columns are not looked at.
    Very long texts are read in parts that end with a piece.
    """
    blocks = materialize(read_blocks(docs, text, group, block), "blocks")
    words = blocks.where("pos > 0").groupBy("grp", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    ids = materialize(numbered(materialize(words, "words")), "ids")
    sizes = blocks.where("pos = 0").groupBy("grp").agg(F.sum("n").alias("total"))
    phrases = materialize(count_phrases(blocks, ids, least, shard, round_bits), "phrases")
    scored = materialize(score(phrases, ids.select("id", "f"), cover), "scored")
    spelt = (
        scored.select("ids", F.posexplode("ids").alias("p", "id"))
        .join(ids.select("id", "grp", "word"), "id")
        .groupBy("ids")
        .agg(F.min("grp").alias("grp"), F.sort_array(F.collect_list(F.struct("p", "word"))).alias("words"))
        .select("ids", "grp", F.array_join("words.word", " ").alias("phrase"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a group may hold a third of all phrases: the first round cuts salted parts of it
    rows = scored.join(spelt, "ids").withColumn("salt", F.expr(f"pmod(xxhash64(ids), {_SALTS})"))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("grp", "salt").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("grp").orderBy(*order))).where(F.col("rank") <= top)
    found = materialize(
        rows.join(sizes, "grp").select(
            F.col("grp").alias(group), F.col("rank").cast("long"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
        ),
        "collocations",
    )
    discard(blocks, phrases, scored)
    return found
