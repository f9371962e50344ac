"""Benchmark decontamination by templates; DataFrame functions only.

Numbers, names and units become typed placeholders that remember their value, so a
question asked again with other figures has the same template. Windows of eight template words
of every document meet those of the benchmark in a hash join. Windows of one item that lie in
the document at one distance form an alignment; it counts if its slots are consistent, that is if
each value of the item always stands where one and the same value stands in the document.
A document is contaminated by an item if such alignments cover half of the item's windows.

Names are capitalised words that do not begin a sentence; any white space counts as one space. Since
capitals can be changed, there is a second, plain template of every text, in lower case with slots for
numbers and units only. Windows of the plain template count as covered if either meets. A window
needs two words that are no slots, or it meets nothing.

Defined results: NULL, empty and wordless texts are clean, and benchmark items of that kind match
nothing; items and texts shorter than a window are compared by all their words; an item of one word
contaminates only texts of that word, one of nothing but slots contaminates nothing; rows that
repeat id and text share their result; items that repeat count once each. Empty tables: no row, or
all clean. Columns of the documents are carried by ``clean_documents`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import BROADCAST_KEYS, row_key, table, without, written

WINDOW = 8
COVERAGE = 0.5
#: Words that follow a number as its unit.
UNITS = (
    "mm cm m km inch inches feet foot ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent degree degrees celsius kmh mph watt watts volt volts"
).split()
_NAME = r"(?<=[\p{L}\p{N},;'’)] )\p{Lu}[\p{L}'’-]*"
_NUMBER = r"(?<![\p{L}\p{N}<=])[-+$€£]?\p{Nd}[\p{Nd}.,:/]*%?"
_UNIT = r"(?<=[\p{Nd}.,%]> )(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}])"
_MARKS = r"[^\p{L}\p{N}<>=\x20\x09-\x0D]+"


def _spaced(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _slotted(spaced: Column, named: bool) -> Column:
    worded = F.regexp_replace(spaced, _NAME, "<name=$0>") if named else F.lower(spaced)
    counted = F.regexp_replace(F.regexp_replace(worded, _NUMBER, "<num=$0>"), _UNIT, "<unit=$0>")
    plain = F.lower(F.regexp_replace(counted, _MARKS, ""))
    return F.array_remove(F.split(plain, " "), "")


def template(text: str, named: bool = True) -> Column:
    """The template words of a text; a slot is ``<kind=value>``."""
    return _slotted(_spaced(text), named)


def _worded(df: DataFrame, text: str, keep: str) -> DataFrame:
    """Both templates of every text, with the hashes of their words, in which slots have no value."""
    kind = lambda w: F.when(w.startswith("<"), F.substring_index(w, "=", 1)).otherwise(w)
    both = F.explode(F.array(*[F.struct(F.lit(n).alias("named"), _slotted(F.col("spaced"), n).alias("words")) for n in (True, False)])).alias("t")
    worded = df.select(keep, _spaced(text).alias("spaced")).select(keep, both).select(keep, "t.*")
    return worded.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(kind(w))))


def _windows(worded: DataFrame, keep: str, sizes: list[int]) -> DataFrame:
    """keep, named, words, n, place, size, window: a row for every window of the given sizes with the hash of its template.
    One row per place first, so that hashes are compiled code and no function of an array element."""
    n = F.size("hashes")
    # Outer, since the filter that Spark infers from an inner one would make the hashes twice.
    placed = worded.select(keep, "named", "words", "hashes", n.alias("n"), F.posexplode_outer("hashes").alias("place", "first"))

    def of(size: int) -> Column:
        rest = [F.get("hashes", F.col("place") + k) for k in range(1, size)]
        return F.xxhash64(F.lit(size), F.col("named"), F.col("first"), *rest)

    fits = lambda s: F.col("place") + s <= F.col("n")
    if len(sizes) == 1:
        made = placed.where(fits(sizes[0])).withColumns({"size": F.lit(sizes[0]), "window": of(sizes[0])})
    else:
        each = F.array(*[F.when(fits(s), F.struct(F.lit(s).alias("size"), of(s).alias("window"))) for s in sizes])
        made = placed.withColumn("w", F.explode(each)).where("w is not null").withColumns({"size": F.col("w.size"), "window": F.col("w.window")})
    return made.select(keep, "named", "words", "n", "place", "size", "window")


def _with_slots(made: DataFrame, widest: int) -> DataFrame:
    """Windows with their slots in place of the words of the whole text. It is compiled code, and a generator, so that Spark
    neither moves it into a later step nor hands the words on row by row: those rows would take the square of a text's length."""
    word = lambda k: F.get("words", F.col("place") + k)
    slot = lambda k: F.when((F.col("size") > k) & word(k).startswith("<"), word(k)).otherwise("")
    return made.withColumn("slots", F.explode(F.array(F.array_remove(F.array(*[slot(k) for k in range(widest)]), "")))).drop("words")


def _sent(listed: DataFrame) -> tuple[DataFrame, bool]:
    """A written table, and whether it is small enough to be sent to every executor."""
    small = listed.count() <= BROADCAST_KEYS
    return F.broadcast(listed) if small else listed, small


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    window: int = WINDOW, coverage: float = COVERAGE,
) -> DataFrame:
    """key, item_id, covered: documents (``row_key``) and the items that contaminate them."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col("text").alias("body"))
    items = _worded(items, "body", "item_id").where(F.size("words") > 0)
    # At most ``window`` numbers.
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect())
    if not sizes:
        return docs.select(row_key(id_col, text_col).alias("key"), F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("covered")).where(
            "false"
        )
    # A window that an item repeats counts once, at its first place.
    listed = _windows(items, "item_id", sizes).where(F.col("size") == F.least("n", F.lit(window)))
    listed = _with_slots(listed, sizes[-1]).groupBy("item_id", "named", "size", "window").agg(F.min(F.struct("place", "slots")).alias("w"))
    listed = written(listed.select("item_id", "named", "size", "window", F.col("w.place").alias("item_place"), F.col("w.slots").alias("item_slots")), "items")
    whole = listed.groupBy("item_id").agg(F.count_if("named").alias("named_windows"), F.count_if(~F.col("named")).alias("plain_windows"))
    # Windows of slots tell nothing, nor does a word alone, unless it is the whole text.
    words = F.col("size") - F.size("item_slots")
    telling = (words >= 2) | ((F.col("size") == 1) & (words == 1))
    own = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("body"))
    each = _windows(_worded(own, "body", "key"), "key", sizes).drop("named")
    asked, sent = _sent(listed)
    asked = asked.where(telling).drop("size")
    # Slots are cut out of the windows that met, or of all where windows are shuffled.
    met = _with_slots(each.join(asked, "window"), sizes[-1]) if sent else _with_slots(each, sizes[-1]).join(asked, "window")
    met = met.where((F.col("size") > 1) | (F.col("n") == 1))
    met = met.withColumn("shift", F.col("place") - F.col("item_place")).groupBy("key", "item_id", "named", "shift").agg(
        F.collect_set("item_place").alias("places"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))
    consistent = met.where(F.size(values) == F.size("pairs"))
    places = lambda of: F.size(F.array_distinct(F.flatten(F.collect_list(of))))
    held = consistent.groupBy("key", "item_id").agg(places(F.when(F.col("named"), F.col("places"))).alias("n_named"), places("places").alias("n"))
    share = F.greatest(F.col("n_named") / F.col("named_windows"), F.least(F.col("n") / F.col("plain_windows"), F.lit(1.0)))
    return held.join(whole, "item_id").where(share >= coverage).select("key", "item_id", share.alias("covered"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, contaminated, items (those that contaminate it), covered (the largest share) for every row."""
    found = matches(docs, benchmark, id_col, text_col, item_col, window, coverage)
    found = found.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("covered").alias("covered"))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"))
    return rows.join(found, "key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("covered", F.lit(0.0)).alias("covered"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The documents that no item contaminates, with all columns of the input."""
    found = written(matches(docs, benchmark, id_col, text_col, item_col, window, coverage).select("key"), "contaminated")
    return without(docs, id_col, text_col, found)


def query(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
