"""Phrase collocations by SON partitioning: local supports, their union, exact counts.

The documents are dealt into shards by a hash of their text. A phrase with f occurrences in
all has at least its proportional part of them in one shard, so a shard's support is the global one
times the shard's part of the language's words, rounded up.

1. Each shard is mined completely. It may be far larger than a task: tasks count
   phrases of one to four words in blocks of text, in numpy, and send sorted 32-bit hashes
   with their counts, packed, to the (shard, language, part) they belong to; there the counts add up
   and those with local support stay. Hashes that collide only add candidates.
2. The union of what is frequent in any shard is written. A bitmap of fixed size, made of it, goes to
   all tasks, which read the texts again and send the phrases, as words, that it lets through, counted per
   block. A fold by the words gives exact counts, without hashes; what the bitmap let through by chance
   falls short of the support there.
3. Cuts, scores and containment are joins over frequent phrases only.

Defined results: NULL text is empty, NULL language is ``und``. Repeated rows and NULL ids count like any
others; ids aren't read. A text without words adds nothing. Texts are read whole; a long one makes its block longer.
An empty table gives an empty result. Further columns of the input are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respfeat.llm.common import body, table, written
from respfeat.llm.words import window_hashes

SUPPORT, LONGEST, TOP = 30, 4, 2000
#: A phrase inside a longer one with this percentage of its occurrences is left out.
COVERED = 80
SHARDS = 8
#: Lots of a language's phrases that are ranked before all of them.
LOTS = 32
#: Text that a task counts at a time, and words of all shards to a part.
BLOCK_BYTES, PART_WORDS = 2 << 20, 2_000_000
#: The bitmap of candidates has 2^BITS bits, whatever the input.
BITS = 26

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 in a word, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 32]] = 1
_CLASS[[*range(10, 14), *b".,;:!?"]] = 2


class _Block:
    """Tokens of some texts: their words as codes, and where each piece ends."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _CLASS[data]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        spelled = _LOWER[data[inside]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)]).dictionary_encode()
        self.words = words.dictionary
        self.codes = words.indices.to_numpy()
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
        each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()), np.uint64, len(self.words))
        self.hashes = each[self.codes] if len(each) else np.zeros(0, np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of each phrase of this many words."""
        n = len(self.codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[: max(n, 0)] == self.piece[size - 1 :])
        return at, window_hashes(self.hashes, size)[at]


def _blocks(batches, *columns):
    """(rows of other columns, block of their texts), a bounded number of bytes at a time."""
    rows, texts, size = [], [], 0
    for b in batches:
        others = list(zip(*(b[c].to_pylist() for c in columns)))
        for row, text in zip(others, b["text"]):
            text = text.as_py()
            rows.append(row)
            texts.append(text)
            size += len(text) + 1
            if size >= BLOCK_BYTES:
                yield rows, _Block(texts)
                rows, texts, size = [], [], 0
    if rows:
        yield rows, _Block(texts)


def _groups(rows: list) -> tuple[list, np.ndarray]:
    """Distinct rows, and the number of each row's own among them."""
    number: dict = {}
    of = np.fromiter((number.setdefault(r, len(number)) for r in rows), np.int64, len(rows))
    return list(number), of


def _count(batches):
    for rows, block in _blocks(batches, "shard", "lang"):
        groups, of = _groups(rows)
        n = np.bincount(of[block.doc], minlength=len(groups))
        yield pa.record_batch(
            [pa.array([g[0] for g in groups], pa.int64()), pa.array([g[1] for g in groups], pa.string()), pa.array(n, pa.int64())], names=["shard", "lang", "n"]
        )


def _of_language(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), seed=1))


def _address(h: np.ndarray, parts: int) -> np.ndarray:
    """What a phrase hash is known by in the mining: part in the upper, hash in the lower 32 bits."""
    return ((h >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))


def _packed(a: np.ndarray) -> bytes:
    """Sorted numbers as byte planes, which compress well."""
    return a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


_PACK = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _mine(parts: int, longest: int):
    """Texts -> per block, shard, language and part: the phrases' hashes with their counts."""

    def run(batches):
        for rows, block in _blocks(batches, "shard", "lang"):
            groups, of = _groups(rows)
            salts = np.array([_of_language(lang) for _, lang in groups], np.uint64)
            found, whose = [], []
            for size in range(1, longest + 1):
                at, h = block.windows(size)
                group = of[block.doc[at]]
                found.append(_address(h ^ salts[group], parts))
                whose.append(group.astype(np.uint16 if len(groups) < 1 << 16 else np.int64))
            address, group = np.concatenate(found), np.concatenate(whose)
            order = np.argsort(group, kind="stable")
            address = address[order]
            ends = np.cumsum(np.bincount(group, minlength=len(groups)))
            out: list[list] = [[], [], [], [], []]
            lo = 0
            for (shard, lang), hi in zip(groups, ends):
                keys, counts = np.unique(address[lo:hi], return_counts=True)
                lo = hi
                part = (keys >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    for column, value in zip(out, (shard, lang, int(part[a]), _packed(keys[a:b]), _packed(counts[a:b]))):
                        column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _PACK)], schema=_PACK)

    return run


def _supported(batches):
    """Packs in the order of (shard, lang, part) -> addresses of what has local support there."""
    at, least, keys, counts = None, 1, [], []

    def frequent():
        k = np.concatenate(keys)
        order = np.argsort(k, kind="stable")
        k, c = k[order], np.concatenate(counts)[order].astype(np.int64)
        first = np.flatnonzero(np.diff(k.astype(np.int64), prepend=-1))
        stay = k[first][np.add.reduceat(c, first) >= least].astype(np.int64)
        return pa.record_batch([pa.array(stay | at[2] << 32, pa.int64())], names=["address"])

    for b in batches:
        for shard, lang, part, t, k, c in zip(*(b[x].to_pylist() for x in ("shard", "lang", "part", "least", "keys", "counts"))):
            if (shard, lang, part) != at:
                if keys:
                    yield frequent()
                at, least, keys, counts = (shard, lang, part), t, [], []
            keys.append(_unpacked(k))
            counts.append(_unpacked(c))
    if keys:
        yield frequent()


_SEEN = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _spell(longest: int, bitmap):
    """Texts -> per block: the phrases that the bitmap lets through, as words, with their counts."""

    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for rows, block in _blocks(batches, "lang"):
            groups, of = _groups(rows)
            salts = np.array([_of_language(lang) for (lang,) in groups], np.uint64)
            for size in range(1, longest + 1):
                at, h = block.windows(size)
                group = of[block.doc[at]]
                h = h ^ salts[group]
                low = h & np.uint64((1 << BITS) - 1)
                hit = np.flatnonzero(bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                at, h, group = at[hit], h[hit], group[hit]
                if not len(at):
                    continue
                spelled = np.stack([group, *(block.codes[at + j] for j in range(size))])
                order = np.argsort(h, kind="stable")
                h, spelled = h[order], spelled[:, order]
                # Equal hashes stand together; where the words differ all the same, sort by the words.
                new = np.diff(h, prepend=~h[:1]) != 0
                if (new[1:] != (spelled[:, 1:] != spelled[:, :-1]).any(0)).any():
                    order = np.lexsort(spelled)
                    h, spelled = h[order], spelled[:, order]
                    new[1:] = (spelled[:, 1:] != spelled[:, :-1]).any(0)
                first = np.flatnonzero(new)
                n = np.diff(first, append=len(h))
                words = [block.words.take(pa.array(spelled[1 + j][first])) for j in range(size)]
                phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if size > 1 else words[0]
                langs = pa.array([groups[g][0] for g in spelled[0][first]], pa.string())
                sizes = pa.array(np.full(len(first), size, np.int32))
                yield pa.record_batch([langs, sizes, phrase.cast(pa.string()), pa.array(n, pa.int64())], schema=_SEEN)

    return run


def _bitmap(candidates: DataFrame) -> bytes:
    """2^BITS bits, folded to words of 64 before they leave the tasks."""
    low = F.col("address").bitwiseAND((1 << BITS) - 1)
    words = candidates.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(address & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for b in words.toArrow().to_batches():
        out[b["word"].to_numpy()] = b["bits"].to_numpy()
    return out.astype("<i8").tobytes()


def frequent_phrases(
    df: DataFrame, lang: str = "lang", text: str = "text", support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases with the support, (lang, n) words of each language); both written tables."""
    spark = df.sparkSession
    docs = df.select(
        F.pmod(F.xxhash64(body(text)), F.lit(shards)).alias("shard"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), body(text).alias("text")
    )
    dealt = written(docs.mapInArrow(_count, "shard long, lang string, n long").groupBy("shard", "lang").agg(F.sum("n").alias("n")), "dealt")
    total = written(dealt.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "words")
    parts = 1 + (total.agg(F.sum("n")).first()[0] or 0) // PART_WORDS
    least = dealt.withColumnRenamed("n", "own").join(total, "lang").select(
        "shard", "lang", F.expr(f"greatest(1, cast((cast({support} as decimal(20,0)) * own + n - 1) div n as bigint))").alias("least")
    )
    packs = docs.mapInArrow(_mine(parts, longest), "shard long, lang string, part long, keys binary, counts binary")
    key = ["shard", "lang", "part"]
    mined = packs.join(least, ["shard", "lang"]).repartition(*key).sortWithinPartitions(*key).mapInArrow(_supported, "address long")
    candidates = written(mined.distinct(), "candidates")
    bitmap = spark.sparkContext.broadcast(_bitmap(candidates))
    seen = docs.select("lang", "text").mapInArrow(_spell(longest, bitmap), "lang string, words int, phrase string, n long")
    exact = seen.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    return written(exact, "phrases"), total


def collocations(
    df: DataFrame, lang: str = "lang", text: str = "text", support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, shards: int = SHARDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    frequent, total = frequent_phrases(df, lang, text, support, longest, shards)
    parts = F.split("phrase", " ")
    several = frequent.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    counts = frequent.select("lang", "phrase", "f")
    cuts = several.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words")), " ").alias("rest"),
    )
    cut = (
        cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .withColumn("score", F.expr("cast(cast(2000000 as decimal(8,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + r) as bigint)"))
    )
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    # Phrases inside longer ones, with the most occurrences of any such.
    spans = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> struct(i, m))))")
    inner = several.where("words > 2").select("lang", "a", parts.alias("all"), F.explode(spans).alias("span")).select(
        "lang", F.array_join(F.slice("all", F.col("span.i"), F.col("span.m")), " ").alias("phrase"), "a"
    )
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(19,0)") * F.col("longer") < F.lit(covered).cast("decimal(19,0)") * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The first of each lot before the first of all, so that a language's last sort is of bounded size.
    lots = alone.select("lang", "phrase", "a", "low.*", F.pmod(F.hash("phrase"), F.lit(LOTS)).alias("lot"))
    first = lots.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), runs as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), phrases as (
    select lang, k as words, array_to_string(w[i:i + k - 1], ' ') as phrase
    from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from runs, (values (1), (2), (3), (4)) sizes(k) where len(w) >= k)
), f as (
    select lang, words, phrase, count(*) as f from phrases group by all having count(*) >= 30
), totals as (
    select lang, sum(len(w))::bigint as n from runs group by lang
), cuts as (
    select lang, phrase, f as a, string_split(phrase, ' ') as w, unnest(generate_series(1, words - 1)) as k from f where words > 1
), scored as (
    select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, ((2000000::hugeint * c.a) // (x.f + y.f))::bigint as score
    from cuts c
    join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
    join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest as (
    select lang, phrase, a, l, r, score from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
    select f.lang, array_to_string(string_split(f.phrase, ' ')[s.i:s.j], ' ') as inner_phrase, max(f.f) as most
    from f, (values (1, 2), (2, 3), (3, 4), (1, 3), (2, 4)) s(i, j)
    where f.words > 2 and s.j <= f.words and s.j - s.i + 1 < f.words
    group by all
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from lowest join totals using (lang)
where not exists (from longer where longer.lang = lowest.lang and inner_phrase = phrase and 100::hugeint * most >= 80 * a)
qualify rank <= 2000
"""
