"""Benchmark decontamination by templates.

Words become lower case; numbers, names and units become typed placeholders. Windows of eight template words of
documents and of benchmark items meet in a hash join. Along each alignment of an item with a document, a value that
fills a slot of the item must always stand against one and the same value in the document: then the passage is the
item, exact or with other parameters. Windows that equal the item's word for word count whatever the others hold.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh, stored, text_or_empty

WIDTH = 8
# A window of placeholders and few words is common to many texts; it counts only with so many plain words.
PLAIN_LEAST = 4
COVERAGE = 0.3
# So many windows in a row (13 words) are enough, however long the item is.
RUN = 6
# Rows of a table of the benchmark up to which it is broadcast (windows: some 50 MB); larger ones are joined by shuffle.
BROADCAST_ROWS = 400_000
# Words of slots, in all rows together, up to which the values of items are broadcast.
BROADCAST_SLOTS = 4_000_000

UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "feet", "foot", "mile", "miles", "mg", "g", "kg", "gram", "grams", "ton",
    "tons", "pound", "pounds", "ml", "l", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes",
    "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro",
    "euros", "cent", "cents", "percent", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilogram",
    "kilograms", "degree", "degrees", "watt", "watts", "volt", "volts", "mph", "kmh",
)
START = "\x01"


def words_of(text: Column) -> Column:
    """Runs of letters and digits; separators within numbers go, and the first word of a sentence is marked."""
    joined = F.when(text.rlike("[0-9][.,][0-9]"), F.regexp_replace(text, r"(?<=[0-9])[.,](?=[0-9])", "")).otherwise(text)
    marked = F.regexp_replace(joined, r"(^|[.!?:\n])[^\p{L}\p{N}]*(?=\p{Lu})", " " + START)
    return F.filter(F.split(marked, rf"[^\p{{L}}\p{{N}}{START}]+"), lambda w: w != "")


def kind_of(word: Column, low: Column) -> Column:
    """The placeholder a word becomes, null for a plain word. The first word of a sentence is never a name."""
    first = F.substring(word, 1, 1)
    return F.when(first.between("0", "9"), "<number>").when(low.isin(*UNITS), "<unit>").when(
        F.substring(low, 1, 1) != first, "<name>")


def template_key(word: Column) -> Column:
    """The hash of a template word: the placeholder's, or the plain word's."""
    low = F.lower(word)
    return F.xxhash64(F.coalesce(kind_of(word, low), F.ltrim(low, F.lit(START))))


def slot_value(word: Column) -> Column:
    low = F.lower(word)
    return F.when(kind_of(word, low).isNotNull(), low)


def windows(rows: DataFrame, *ids: str) -> DataFrame:
    """(ids, at, window) from rows with `keys`: the hash of each window of template words, by its place."""
    keys = F.col("keys")
    one = lambda i: F.xxhash64(*[F.get(keys, i + k) for k in range(WIDTH)])
    each = F.when(F.size(keys) >= WIDTH, F.transform(F.sequence(F.lit(0), F.size(keys) - WIDTH), one))
    # The outer form: for the inner one the optimizer adds a filter that computes all windows a second time.
    return rows.select(*ids, F.posexplode_outer(each).alias("at", "window"))


def has_run(places: Column) -> Column:
    """Whether an ascending array of places holds RUN in a row."""
    return F.exists(F.transform(places, lambda at, i: F.coalesce(F.get(places, i + RUN - 1) == at + RUN - 1, F.lit(False))), lambda v: v)


def normal_text(words: Column, text: Column) -> Column:
    """The words in lower case, or the text without outer blanks if there is none."""
    return F.when(F.size(words) > 0, F.lower(F.array_join(F.transform(words, lambda w: F.ltrim(w, F.lit(START))), " "))).otherwise(F.trim(text))


def benchmark_items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, template, variant, keys, slots, normal): the hashes of an item's template and of the values in its slots."""
    items = benchmark.select(F.col(item_id).alias("item_id"), text_or_empty(text).alias("text"), words_of(text_or_empty(text)).alias("words")).select(
        "item_id", normal_text(F.col("words"), F.col("text")).alias("normal"), F.transform("words", template_key).alias("keys"), F.transform("words", slot_value).alias("slots"))
    return stored(items.select(
        "item_id", F.xxhash64("keys").alias("template"), F.xxhash64("slots").alias("variant"), "keys", "slots", "normal").distinct())


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(template, item_at, window, item_windows) of each distinct template; which places are slots, it fixes itself."""
    first = items.groupBy("template").agg(F.min(F.struct("keys", "slots")).alias("first")).select("template", "first.*")
    filled = lambda at: F.size(F.filter(F.slice("slots", at + 1, F.lit(WIDTH)), lambda s: s.isNotNull()))
    usable = windows(first, "template", "slots").filter("window IS NOT NULL").filter(filled(F.col("at")) <= WIDTH - PLAIN_LEAST)
    total = usable.groupBy("template").agg(F.count(F.lit(1)).alias("item_windows"))
    return stored(usable.join(total, "template").select("template", F.col("at").alias("item_at"), "window", "item_windows"))


def found(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, kind, n_windows, item_windows, coverage) per document and item found in it.

    A window that equals the item's in its slots too is found; the others of its alignment are, if each value of the item
    stands against one value throughout them. kind is exact if equal windows alone suffice, else re-parameterised;
    coverage is the share of the item's windows found, at least COVERAGE unless RUN windows in a row are. An item without
    a usable window (fewer than WIDTH words, or too few plain ones) is found in documents whose words are all the same,
    or which are the same but for outer blanks if they have no word; it has 0 windows and coverage 1. Null and empty
    texts match nothing. Repeated documents and repeated items count once; each item of one template is held
    against the document by its own values. Rows with a null id are compared too. Other columns of either table are not read.
    """
    return _found(df, benchmark, text, doc_id, item_id, item_text, False).drop("template")


def _found(df, benchmark, text, doc_id, item_id, item_text, whole):
    """`whole`: an alignment counts only as a whole, none of its windows for itself."""
    items = benchmark_items(benchmark, item_id, item_text)
    each = benchmark_windows(items)
    # Each side is broadcast by its own count: windows of distinct templates, and rows and words of items.
    n_items, n_slots = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("slots")), F.lit(0))).first()
    hinted = lambda small: F.broadcast if small else lambda table: table
    by_window = hinted(each.count() <= BROADCAST_ROWS)
    by_item = hinted(n_items <= BROADCAST_ROWS)
    by_slots = hinted(n_items <= BROADCAST_ROWS and n_slots <= BROADCAST_SLOTS)
    own = F.xxhash64(text_or_empty(text)).alias("text_hash")
    split = words_of(text_or_empty(text)).alias("words")
    keys = df.select(F.col(doc_id).alias("doc_id"), own, split).select(
        "doc_id", "text_hash", F.transform("words", template_key).alias("keys"))
    # Most windows meet nothing, so slots are read in a second pass, over documents with a met window alone.
    met = stored(windows(keys, "doc_id", "text_hash").join(by_window(each), "window").drop("window"))
    texts = df.select(own, split).join(met.select("text_hash").distinct(), "text_hash", "left_semi")
    slots = texts.dropDuplicates(["text_hash"]).select("text_hash", F.transform("words", slot_value).alias("doc_slots"))
    # An alignment of a template with a document is one row; then it meets each distinct vector of values of the template.
    lines = met.groupBy("doc_id", "text_hash", "template", "item_windows", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.array_sort(F.collect_set("item_at")).alias("places"))
    variants = items.select("template", "variant", "slots").dropDuplicates(["template", "variant"])
    aligned = lines.join(slots, "text_hash").join(by_slots(variants), "template")
    of_item = lambda at: F.slice("slots", at + 1, F.lit(WIDTH))
    of_doc = lambda at: F.slice("doc_slots", at + F.col("shift") + 1, F.lit(WIDTH))
    aligned = aligned.withColumn("verbatim", F.filter("places", lambda at: of_item(at) == of_doc(at)))
    rest = F.col("places") if whole else F.array_except("places", "verbatim")
    pairs = F.array_distinct(F.flatten(F.transform(rest, lambda at: F.filter(
        F.zip_with(of_item(at), of_doc(at), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"].isNotNull()))))
    aligned = aligned.withColumn("pairs", pairs)
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"])))
    alone = F.when(F.size("verbatim") == F.size("places"), F.col("verbatim")).otherwise(F.array().cast("array<int>")) if whole else F.col("verbatim")
    aligned = aligned.withColumn("alone", alone).withColumn(
        "places", F.when(consistent, F.col("places")).otherwise(F.col("alone")))
    count = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).cast("long")
    result = aligned.groupBy("doc_id", "text_hash", "template", "variant", "item_windows").agg(
        count("places").alias("n_windows"), count("alone").alias("n_verbatim"),
        F.bool_or(has_run(F.col("places"))).alias("run"), F.bool_or(has_run(F.col("alone"))).alias("run_verbatim"))
    coverage = F.col("n_windows") / F.col("item_windows")
    result = result.filter((coverage >= COVERAGE) | F.col("run"))
    ids = items.select("item_id", "template", "variant")
    exact = (F.col("n_verbatim") / F.col("item_windows") >= COVERAGE) | F.col("run_verbatim")
    result = result.join(by_item(ids), ["template", "variant"]).select(
        "doc_id", "text_hash", "item_id", F.when(exact, "exact").otherwise("re-parameterised").alias("kind"),
        "n_windows", "item_windows", coverage.alias("coverage"), "template")
    short = items.join(each.select("template").distinct(), "template", "left_anti").filter("normal <> ''").select(
        "item_id", "template", F.xxhash64("normal").alias("same"))
    if short.isEmpty():
        return result
    normal = df.select(F.col(doc_id).alias("doc_id"), own, text_or_empty(text).alias("text"), split).select(
        "doc_id", "text_hash", F.xxhash64(normal_text(F.col("words"), F.col("text"))).alias("same"))
    # Rows of one document and text count once, as above.
    equal = normal.join(by_item(short), "same").select("doc_id", "text_hash", "item_id", "template").distinct()
    return result.unionByName(equal.select(
        "doc_id", "text_hash", "item_id", F.lit("exact").alias("kind"), F.lit(0).cast("long").alias("n_windows"),
        F.lit(0).cast("long").alias("item_windows"), F.lit(1.0).alias("coverage"), "template"))


def matches(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `found` for alignments that are consistent as a whole; of items of one template that a document holds
    so the least id stands for all."""
    rows = _found(df, benchmark, text, doc_id, item_id, item_text, True)
    least = F.min(F.struct("item_id", "kind", "n_windows", "item_windows", "coverage")).alias("least")
    return rows.groupBy("doc_id", "text_hash", "template").agg(least).select("doc_id", "text_hash", "least.*")


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows, with their own columns, in which no item was found.

    Rows with a null or empty text stay, and so do repeated rows. An empty table or benchmark changes nothing. Columns may
    have any names.
    """
    name = fresh("found_hash", df.columns)
    leaked = found(df, benchmark, text, doc_id).select(F.col("text_hash").alias(name)).distinct()
    return df.join(leaked, F.xxhash64(text_or_empty(text)) == F.col(name), "left_anti")
