"""Benchmark decontamination by template windows. DataFrame operations only.

Texts become templates: words in lower case without punctuation, with numbers, capitalised names and units behind numbers replaced by typed
placeholders. Windows of WINDOW template words of the documents are hash-joined with those of the benchmark. For what meets, the templates are compared
word by word and the values in the slots must correspond one to one, in the window and, for windows whose values are not the item's own, over the whole
matched stretch; so a question with other numbers and names is found, a window whose slots are filled at random is not, and a copy with one value changed
is found by its unchanged windows. Names are told by their capitals; so that a copy in capitals, lower or title case is found, windows of lower-cased words
are searched as well (``any_case``).

Each benchmark window has an anchor: of its literal words the one that the benchmark holds least often. A document's words meet the anchors first, by hash
and where they are read; only around an anchor are a seed (the anchor and the two template words behind it) and then whole windows made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

WINDOW = 10
#: Words of a window that are no placeholders, and different ones among them; with fewer, a window says too little.
LITERALS, DIFFERENT = 5, 4
#: Benchmark windows up to which anchors and seeds (some 60 bytes a window) go to all tasks; the windows of documents meet a larger benchmark in a shuffle.
SET_ROWS = 2_000_000
#: Benchmark windows up to which the windows themselves (about half a kilobyte each) are broadcast to what the seeds found; beyond, Spark picks the join.
INDEX_ROWS = 100_000
#: Template words of a seed, and words of a document that are searched as one row (with a window's words on both sides).
SEED, BLOCK = 3, 256

NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
#: Templates of a text: names, numbers and units typed; numbers and units typed, in lower case.
TYPED, LOWER = "typed", "lower"
#: The plain words in lower case, for items without a window that says enough.
WHOLE = "whole"
#: Letters of scripts without blanks between words; each is a word of its own. All lie from U+0E00 on, which is cheaper to ask first than the script.
UNSPACED = r"[\u0E00-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]"

#: Units that are replaced behind a number. Fixed values.
UNITS = [
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg", "t", "ton", "tons", "ounce", "ounces",
    "oz", "pound", "pounds", "lb", "lbs", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute",
    "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "degree", "degrees", "celsius",
    "fahrenheit", "kelvin", "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "kmh", "mph", "hz", "khz", "mhz", "ghz", "w", "kw",
    "kwh", "v", "volt", "volts", "joule", "joules", "newton", "newtons", "byte", "bytes", "kb", "mb", "gb", "tb",
]


def plain(text: Column) -> Column:
    """The text without punctuation and with one blank between words, and between the letters of scripts that write none."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}\s]+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(letters, f"({UNSPACED})", " $1 "), r"\s+", " "))


def template(words: Column, names: bool = True) -> Column:
    """The template of a plain text; it has as many words as the text. Without ``names`` they stay as words in lower case."""
    slots = F.regexp_replace(words, r"\p{Lu}(?<![^ ].)\p{Ll}[^ ]*", NAME) if names else words
    slots = F.regexp_replace(slots, r"(?<![^ ])[^ <\p{N}]*+\p{N}[^ ]*", NUMBER)
    return F.regexp_replace(F.lower(slots), f"({NUMBER} )(?:{'|'.join(UNITS)})(?![^ ])", f"$1{UNIT}")


def split_words(text: Column) -> Column:
    # the empty text gives one empty word, which no window that says enough can hold
    return F.split(text, " ")


def literal(word: Column) -> Column:
    return ~F.startswith(word, F.lit("<"))


def starts(words: Column, width: Column | int) -> Column:
    """1, 2, ... up to the last window of ``width`` words; empty when there is none."""
    last = F.size(words) - width + 1
    return F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def window_hashes(words: Column, width: int) -> Column:
    return F.transform(starts(words, width), lambda i: F.xxhash64(F.slice(words, i, width)))


def forms(any_case: bool) -> list[str]:
    return [TYPED, LOWER] if any_case else [TYPED]


def templates_of(texts: DataFrame, wanted: list[str]) -> DataFrame:
    """``texts`` with a column of template words for each wanted form, from the column ``plain``."""
    made = {TYPED: template(F.col("plain")), LOWER: template(F.col("plain"), names=False), WHOLE: F.lower("plain")}
    return texts.select("*", *[split_words(made[f]).alias(f) for f in wanted])


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, any_case: bool = False) -> DataFrame:
    """(hash, form, item_id, item_at, width, item_template, item_words, item_size) for the windows that say enough; an item shorter than a window is one.

    An item without such a window has all its windows of plain words, as form WHOLE.
    """
    texts = items.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), plain(F.col(text_col)).alias("plain"))
    cut = templates_of(texts.filter("plain <> ''"), [*forms(any_case), WHOLE]).withColumn("words", split_words(F.col("plain")))
    cut = cut.withColumn("width", F.least(F.size("words"), F.lit(window)))

    def windows(form: str) -> Column:
        part = lambda c, i: F.slice(F.col(c), i, F.col("width"))
        return F.transform(starts(F.col("words"), F.col("width")), lambda i: F.struct(F.lit(form).alias("form"), i.alias("item_at"), part(form, i).alias("item_template"), part("words", i).alias("item_words")))

    def enough(w: Column) -> Column:
        solid = F.filter(w["item_template"], literal)
        return (F.size(solid) >= LITERALS) & (F.size(F.array_distinct(solid)) >= DIFFERENT)

    told = cut.withColumn("told", F.filter(F.concat(*[windows(f) for f in forms(any_case)]), enough))
    shown = F.when(F.size("told") > 0, F.col("told")).otherwise(windows(WHOLE))
    each = told.select("item_id", "width", F.size("words").alias("item_size"), F.explode(shown).alias("w"))
    return each.select("item_id", "width", "item_size", "w.*").withColumn("hash", F.xxhash64("item_template"))


def with_anchors(index: DataFrame, any_words: Column) -> DataFrame:
    """``index`` with ``anchor`` (hash of a word), its place ``anchor_at`` and ``seed``.

    The anchor is the literal word (any word where ``any_words``) that the fewest windows hold, of those with a seed's words from there on; ties by hash and place.
    """
    kinds = index.select("form", "width", "hash", "item_template", any_words.alias("any_words")).dropDuplicates(["form", "width", "hash", "item_template"])
    each = kinds.select("form", "width", "hash", "item_template", "any_words", F.posexplode("item_template").alias("at", "word"))
    each = each.filter((literal(F.col("word")) | F.col("any_words")) & (F.col("at") <= F.col("width") - F.least(F.col("width"), F.lit(SEED))))
    each = each.select("form", "width", "hash", "item_template", (F.col("at") + 1).alias("at"), F.xxhash64("word").alias("word"))
    each = each.join(each.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word")
    rarest = each.groupBy("form", "width", "hash", "item_template").agg(F.min(F.struct("n", "word", "at")).alias("a"))
    seed = seed_hash(F.col("form"), F.slice("item_template", F.col("a.at"), F.least(F.col("width"), F.lit(SEED))))
    chosen = rarest.select("form", "width", "hash", "item_template", F.col("a.word").alias("anchor"), F.col("a.at").alias("anchor_at"), seed.alias("seed"))
    return index.join(chosen, ["form", "width", "hash", "item_template"])


def seed_hash(form: Column, words: Column) -> Column:
    return F.xxhash64(form, words)


def template_at(form: Column, words: Column, at: Column, width: Column | int) -> Column:
    """The template words of ``width`` plain words from ``at`` on; the word before tells whether the first is a unit."""
    led = (at > 1).cast("int")
    # places before the first word are filtered, but not always before this is made
    part = F.array_join(F.slice(words, F.greatest(at - led, F.lit(1)), led + width), " ")
    made = F.when(form == TYPED, template(part)).when(form == LOWER, template(part, names=False)).otherwise(F.lower(part))
    return F.slice(split_words(made), led + 1, width)


def blocks_of(words: Column, margin: int) -> Column:
    """Runs of BLOCK words with ``margin`` words more on both sides: (words, own_from, own_to), the run's own words by place."""
    def block(k: Column) -> Column:
        first = F.greatest(k * BLOCK + 1 - margin, F.lit(1))
        last = F.least((k + 1) * BLOCK + margin, F.size(words))
        own = k * BLOCK + 2 - first
        return F.struct(F.slice(words, first, last - first + 1).alias("words"), (first - 1).alias("before"), own.alias("own_from"), (own + BLOCK - 1).alias("own_to"))

    return F.transform(F.sequence(F.lit(0), ((F.size(words) - 1) / BLOCK).cast("int")), block)


def met_at_anchors(texts: DataFrame, index: DataFrame, seeds: list[tuple[str, int]], window: int) -> DataFrame:
    """(id, text_hash, form, at, width, template, words, anchor_at) of the documents' windows that a seed of the index leads to.

    Nothing is shuffled: anchors and seeds are broadcast, and a row holds no more than a block of words, however long the text is.
    """
    anchors = F.broadcast(index.select("anchor").distinct())
    led = F.broadcast(index.select("seed", "form", "width", "anchor_at").distinct())
    # outer, as the filter for empty arrays would otherwise move below the words and make them anew
    cut = texts.select("id", "text_hash", split_words(F.col("plain")).alias("words"))
    cut = cut.select("id", "text_hash", blocks_of(F.col("words"), window).alias("blocks"))
    cut = cut.select("id", "text_hash", F.explode_outer("blocks").alias("b")).select("id", "text_hash", "b.*")
    each = cut.select("*", F.posexplode_outer("words").alias("q", "word")).filter(F.col("q").between(F.col("own_from") - 1, F.col("own_to") - 1))
    each = each.withColumn("anchor", F.xxhash64(F.lower("word"))).join(anchors, "anchor", "left_semi").withColumn("q", F.col("q") + 1)

    made = [seed_hash(F.lit(form), template_at(F.lit(form), F.col("words"), F.col("q"), n)) for form, n in seeds]
    each = each.select("id", "text_hash", "words", "before", "q", F.explode(F.array(*made)).alias("seed")).join(led, "seed")
    each = each.withColumn("i", F.col("q") - F.col("anchor_at") + 1).filter((F.col("i") >= 1) & (F.col("i") + F.col("width") - 1 <= F.size("words")))
    own = F.slice("words", F.greatest("i", F.lit(1)), F.col("width"))
    return each.select(
        "id", "text_hash", "form", (F.col("before") + F.col("i")).alias("at"), "width", "anchor_at",
        template_at(F.col("form"), F.col("words"), F.col("i"), F.col("width")).alias("template"), own.alias("words"),
    )


def met_in_join(cut: DataFrame, index: DataFrame, widths: list[tuple[str, int]], wanted: list[str]) -> DataFrame:
    """The windows of the index for a benchmark of any size: all windows are exploded, joined with the index by their hash, and gathered per document."""
    rows = None
    for form, width in widths:
        own = cut.select("id", "text_hash", F.posexplode_outer(window_hashes(F.col(form), width)).alias("at", "hash"))
        own = own.select("id", "text_hash", F.lit(form).alias("form"), (F.col("at") + 1).alias("at"), F.lit(width).alias("width"), "hash")
        rows = own if rows is None else rows.unionByName(own)
    hit = rows.join(index.select("hash", "form", "width").distinct(), ["hash", "form", "width"], "left_semi")
    # places of a document; for each form and width at most as many as it has words
    hit = hit.groupBy(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(F.collect_set(F.struct("form", "at", "width")).alias("places"))
    hit = cut_lineage(hit, "hits")
    found = cut.join(hit, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))).drop("own_id", "own_hash")
    found = found.withColumn("words", split_words(F.col("plain")))
    part = lambda p, c: F.slice(F.col(c), p["at"], p["width"])
    own_template = lambda p: F.coalesce(*[F.when(p["form"] == form, part(p, form)) for form in wanted])
    places = F.transform("places", lambda p: F.struct(p["form"].alias("form"), p["at"].alias("at"), p["width"].alias("width"), own_template(p).alias("template"), part(p, "words").alias("words")))
    return found.select("id", "text_hash", F.explode_outer(places).alias("w")).filter("w is not null").select("id", "text_hash", "w.*")


def one_to_one(pairs: Column) -> Column:
    """Whether (a, b) pairs match every a with one b and every b with one a."""
    kinds = F.size(F.array_distinct(pairs))
    left = F.size(F.array_distinct(F.transform(pairs, lambda p: p["a"])))
    right = F.size(F.array_distinct(F.transform(pairs, lambda p: p["b"])))
    return (kinds == left) & (kinds == right)


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    set_rows: int = SET_ROWS,
    any_case: bool = False,
) -> DataFrame:
    """One row for each document and benchmark item that share a consistent window: ``id_col``, ``text_hash``, ``item_id``, ``windows``, ``share``, ``exact``.

    ``windows`` counts the shared windows, ``share`` is the part of the item's windows among them, ``exact`` tells whether all slots hold the item's own values,
    those of windows beside them that agree in themselves but not over the stretch included.
    Names are told by their capitals, so a copy in other letter case is found by windows without names only; with ``any_case`` windows of lower-cased words, names
    among them, are searched as well. An item without a window that says enough (short, or mostly numbers or names) is found where all its words stand in order, in any
    letter case. Letters of scripts without blanks count as words. Null texts and texts without a letter or number share nothing. Rows with the same id are told apart by the hash of their text; a
    row that is given twice gives the same row once. Null ids are kept as null. Empty tables give no row; other columns are not read.
    A very long text costs its words as one array, and is searched in blocks.
    """
    index = benchmark_windows(items, item_id_col, item_text_col, window, any_case)
    index = cut_lineage(with_anchors(index, F.col("form") == WHOLE), "benchmark")
    widths = [(r["form"], r["width"]) for r in index.select("form", "width").distinct().orderBy("form", "width").collect()]
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), plain(F.col(text_col)).alias("plain"))
    rows = index.count()
    if rows <= set_rows or not widths:
        seeds = sorted({(form, min(width, SEED)) for form, width in widths}) or [(TYPED, SEED)]
        found = met_at_anchors(texts, index, seeds, window)
    else:
        # words and templates are kept apart from what is made of them, so that each is made once
        # only a benchmark with such items needs the documents' plain words
        wanted = [*forms(any_case), *([WHOLE] if any(form == WHOLE for form, _ in widths) else [])]
        found = met_in_join(templates_of(texts, wanted), index, widths, wanted)
    found = found.withColumn("hash", F.xxhash64("template"))
    items_met = F.broadcast(index) if rows <= INDEX_ROWS else index
    # a window that several seeds lead to counts by its own
    keys = ["hash", "form", "width", *(["anchor_at"] if "anchor_at" in found.columns else [])]
    met = found.join(items_met, keys).filter(F.col("template") == F.col("item_template"))
    slots = F.filter(
        F.zip_with(F.arrays_zip(F.col("item_words").alias("a"), F.col("words").alias("b")), "template", lambda p, t: F.struct(p["a"].alias("a"), p["b"].alias("b"), t.alias("t"))),
        lambda p: ~literal(p["t"]),
    )
    # numbers and names correspond by type
    value = lambda p, c: F.concat(p["t"], F.when(F.col("form") == TYPED, p[c]).otherwise(F.lower(p[c])))
    pairs = F.transform(slots, lambda p: F.struct(value(p, "a").alias("a"), value(p, "b").alias("b")))
    met = met.withColumn("pairs", pairs).filter(one_to_one(F.col("pairs")))
    same = F.forall("pairs", lambda p: p["a"] == p["b"])
    # one stretch of a document against one item; its slots are at most the item's words
    cased = (F.col("form") == TYPED) | (F.col("words") == F.col("item_words"))
    stretch = met.groupBy("id", "text_hash", "item_id", "form", (F.col("at") - F.col("item_at")).alias("offset")).agg(
        F.collect_set("item_at").alias("places"), F.collect_set(F.when(same, F.col("item_at"))).alias("same_places"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"), F.first("item_size").alias("item_size"), F.first("width").alias("width"), F.bool_and(cased).alias("cased"),
    )
    # windows in the item's own words stay whatever stands beside them; the others have to agree over the stretch
    stretch = stretch.withColumn("places", F.when(one_to_one(F.col("pairs")), F.col("places")).otherwise(F.col("same_places"))).filter(F.size("places") > 0)
    # an item of plain words has to be there as a whole
    stretch = stretch.filter((F.col("form") != WHOLE) | (F.size("places") == F.col("item_size") - F.col("width") + 1))
    stretch = stretch.withColumn("exact", same & F.col("cased"))
    counted = stretch.groupBy("id", "text_hash", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("windows"),
        F.first("item_size").alias("item_size"), F.first("width").alias("width"), F.bool_and("exact").alias("exact"),
    )
    share = F.col("windows") / (F.col("item_size") - F.col("width") + 1)
    return counted.select(F.col("id").alias(id_col), "text_hash", "item_id", "windows", share.alias("share"), "exact")
