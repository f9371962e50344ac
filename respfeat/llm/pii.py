"""Personal data by patterns, and the terms that give its owners away; DataFrame functions only.

Patterns find protected entities: e-mail addresses, IP addresses, payment cards, phone
numbers. Information-theoretic sanitisation adds the terms that reveal them. For a term t that
stands in a text with an entity e, anywhere in it, the corpus counts n texts with t, k of them
with e. How strongly t reveals e is the lower bound of P(e | t) that this evidence supports
(Wilson's, one-sided at 90 %), and the information log2(bound / P(e)). A term with a bound of a half
and five bits or more for some entity exceeds the threshold. One text is no evidence: its bound
is 0.38, so a word that merely is rare stays; two texts out of two give 0.55. Where a term looks like a name, that is
capitalised inside a sentence, a text that holds it with e counts as two observations. Such
terms are spans wherever they occur: generalised to a placeholder while the entity is only
likely (bound below 0.9), removed beyond.

The patterns are written so that Java's engine runs in linear time and without recursion:
possessive quantifiers, and starts only where a run of characters starts (or where the last
match ended). They find what the plain patterns find.

Defined results: NULL text counts as empty and has no span. Rows that repeat id and text
share their spans. Positions count code points. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respfeat.llm.common import WORD, bounded, row_key, table, written

#: The kinds in their order, and what each looks like.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without one of these holds no span of the kind.
HINTS = {"email": "@", "phone": "+"}
LIKELY, BITS, CERTAIN = 0.5, 5.0, 0.9
#: Standard deviations of the one-sided bound at 90 %.
SURE = 1.2816
#: A capitalised word that doesn't begin a sentence or a line.
NAME = r"(?<=[\p{L}\p{N},;:'’)(][\x20\x09])\p{Lu}[\p{L}\p{M}'’-]*"
_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
_ROW = "array<struct<kind:int,i:int,gap:int,found:string>>"


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total, i):
        d = F.substr(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("found", "[^0-9]", "")
    parts = F.transform(F.split("found", r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    kind = lambda k: F.col("kind") == KINDS.index(k)
    return (
        F.when(kind("email"), True)
        .when(kind("ip"), F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255)))
        .when(kind("card"), F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def base_spans(texts: DataFrame) -> DataFrame:
    """(key, text) -> key, kind, start, end, found: the valid matches."""

    def of(kind: str) -> Column:
        # Arrays side by side: a lambda that reached for the gaps would split the text for each match.
        gaps = F.split("text", PATTERNS[kind], -1)
        zipped = F.arrays_zip(
            F.transform(gaps, F.length).alias("gap"), F.regexp_extract_all("text", F.lit(PATTERNS[kind]), 0).alias("found"),
        )
        each = F.transform(
            zipped,
            lambda m, i: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), m["gap"].alias("gap"), m["found"].alias("found"),
            ),
        )
        each = F.filter(each, lambda m: m["found"].isNotNull())
        has = F.col("text").contains(HINTS[kind]) if kind in HINTS else F.col("text").rlike(PATTERNS[kind])
        return F.when(has, each).otherwise(F.array().cast(_ROW))

    some = texts.where(F.col("text").contains("@") | F.rlike("text", F.lit("[0-9]")))
    rows = some.select("key", F.explode(F.concat(*[of(k) for k in PATTERNS])).alias("m")).select("key", "m.*")
    return _placed(rows.dropDuplicates(["key", "kind", "i"]), "kind").where(_valid())


def _placed(rows: DataFrame, *within: str) -> DataFrame:
    """Adds start and end: the gaps and matches before, summed up along each text."""
    before = Window.partitionBy("key", *within).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.length("found")).over(before), F.lit(0)) + F.col("gap")
    return rows.withColumn("start", start.cast("long")).withColumn("end", (F.col("start") + F.length("found")).cast("long"))


def _core(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, _EDGES, ""))


def _is_term(core: Column) -> Column:
    return (F.length(core) >= 3) & ~F.rlike(core, F.lit("[@0-9]"))


def least_share(k: Column, n: Column) -> Column:
    """Wilson's lower bound of a share, of which k in n were seen."""
    p, z = k / n, SURE * SURE
    return (p + z / (2 * n) - SURE * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def _representatives(holds: DataFrame) -> DataFrame:
    """key, entity, holders. Entities that the same texts hold reveal alike, so one stands for
    all: a text with many of its own makes no product of them with its terms."""
    mix = F.xxhash64("key")
    held = holds.groupBy("entity").agg(
        F.count("*").alias("holders"), F.bit_xor(mix).alias("x"), F.sum(mix.cast("decimal(38,0)")).alias("s")
    )
    first = held.groupBy("holders", "x", "s").agg(F.min("entity").alias("entity")).select("entity", "holders")
    return written(holds.join(first, "entity"), "holds")


def disclosing_terms(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """term, likely (the highest bound of P(e | t)): the terms that exceed the thresholds."""
    entity = F.xxhash64("kind", F.lower(F.regexp_replace("found", r"[\x20().-]", "")))
    holds = _representatives(written(spans.select("key", entity.alias("entity")).distinct(), "entities"))
    keys = bounded(written(holds.select("key").distinct(), "holding"))
    own = written(texts.join(keys, "key", "left_semi").dropDuplicates(["key"]), "own")
    plain, names = _terms_of(own).withColumn("named", F.lit(0)), _names_of(own).withColumn("named", F.lit(1))
    terms = plain.unionByName(names).where(_is_term(F.col("term"))).groupBy("key", "term").agg(F.max("named").alias("named"))
    # No other pair can reach the threshold: its bound rests on one observation.
    pairs = terms.join(holds, "key").where((F.col("named") == 1) | (F.col("holders") > 1))
    seen = written(pairs.groupBy("term", "entity", "holders").agg(F.count("*").alias("together"), F.sum("named").alias("named")), "pairs")
    candidates = written(seen.select("term").distinct(), "candidates")
    rows, total = texts.agg(F.count("*"), F.count_distinct("key")).first()
    each = _terms_of(texts).distinct() if rows > total else _terms_of(texts)
    found = each.join(bounded(candidates), "term").groupBy("term").agg(F.count("*").alias("documents"))
    likely = least_share(F.col("together") + F.col("named"), F.col("documents") + F.col("named"))
    bits = F.log2(likely / (F.col("holders") / F.lit(total)))
    strong = seen.join(found, "term").where((likely >= LIKELY) & (bits >= BITS))
    return written(strong.groupBy("term").agg(F.max(likely).alias("likely")), "terms")


def _names_of(texts: DataFrame) -> DataFrame:
    """(key, term): words of every whole text that look like names."""
    return texts.select("key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(NAME), 0))).alias("w")).select("key", _core(F.col("w")).alias("term"))


def _terms_of(texts: DataFrame) -> DataFrame:
    """(key, term): the distinct terms of every whole text."""
    # Marks at the edges of words go in one pass over the text, so that words need none.
    bare = F.regexp_replace(F.lower("text"), r"(?<![\p{L}\p{N}])[^\p{L}\p{N}\x20\x09-\x0D]+|[^\p{L}\p{N}\x20\x09-\x0D]+(?![\p{L}\p{N}])", "")
    return texts.select("key", F.explode(F.array_distinct(F.split(bare, r"[\x20\x09-\x0D]+"))).alias("term"))


def term_spans(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """key, kind, start, end, likely: every place where a disclosing term stands."""
    listed = bounded(terms)
    keys = written(_terms_of(texts).join(listed, "term", "left_semi").select("key").distinct(), "holders")
    held = texts.join(bounded(keys), "key", "left_semi").dropDuplicates(["key"])
    gaps = F.transform(F.split("text", WORD, -1), F.length)
    words = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all("text", F.lit(WORD), 0).alias("found"))
    rows = held.select("key", F.posexplode(words).alias("i", "m")).select("key", "i", "m.gap", "m.found")
    placed = _placed(rows.where(F.col("found").isNotNull()))
    core = F.regexp_replace("found", _EDGES, "")
    lead = F.length("found") - F.length(F.regexp_replace("found", r"^[^\p{L}\p{N}]+", ""))
    cores = placed.select("key", _core(F.col("found")).alias("term"), (F.col("start") + lead).alias("start"), F.length(core).alias("size"))
    return cores.join(listed, "term").select(
        "key", F.lit(KINDS.index("term")).alias("kind"), "start", (F.col("start") + F.col("size")).alias("end"), "likely"
    )


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def all_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, kind, start, end, likely: base spans and disclosing terms, written."""
    texts = _keyed(df, id_col, text_col)
    base = written(base_spans(texts.select("key", "text")), "spans")
    terms = disclosing_terms(texts.select("key", "text"), base)
    own = base.select("key", "kind", "start", "end", F.lit(1.0).alias("likely"))
    return written(own.unionByName(term_spans(texts.select("key", "text"), terms)), "all-spans")


def _listed(spans: Column) -> Column:
    name = lambda s: F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row."""
    one = F.struct("start", "kind", "end")
    per = all_spans(df, id_col, text_col).groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("s"))
    base = F.filter("s", lambda s: s["kind"] < KINDS.index("term"))
    count = lambda k: F.size(F.filter("s", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    rows = df.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key")).join(per, "key", "left")
    rows = rows.withColumn("s", F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:4]], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("s")).alias("spans")
    )


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: with each run of overlapping spans replaced by the kind of its first, in
    brackets; terms that all but name the entity are removed without a trace."""
    spans = all_spans(df, id_col, text_col)
    by = Window.partitionBy("key").orderBy("start", "kind")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("run", F.sum(F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0)).over(by))
    kind = F.min(F.struct("start", "kind", "likely"))
    merged = runs.groupBy("key", "run").agg(kind.alias("f"), F.max("end").alias("end")).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("f.start", "end", "f.kind", "f.likely"))).alias("s")
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    shown = lambda s: F.when((s["kind"] == KINDS.index("term")) & (s["likely"] >= CERTAIN), F.lit("")).otherwise(F.get(names, s["kind"]))
    texts = _keyed(df, id_col, text_col).join(merged, "key", "left")
    parts = F.transform(
        "s",
        lambda s, i: F.concat(
            F.substr("text", (F.coalesce(F.get("s", i - 1)["end"], F.lit(0)) + 1).cast("int"),
                     (s["start"] - F.coalesce(F.get("s", i - 1)["end"], F.lit(0))).cast("int")), shown(s)),
    )
    tail = F.substr("text", (F.element_at("s", -1)["end"] + 1).cast("int"), F.length("text"))
    return texts.select("doc_id", F.when(F.col("s").isNull(), F.col("text")).otherwise(F.concat(F.array_join(parts, ""), tail)).alias("text"))


def query(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"))
