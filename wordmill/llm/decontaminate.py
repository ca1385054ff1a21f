"""Benchmark decontamination by template canonicalisation (operator 2),
DataFrame functions only.

Numbers, names and units of a text become typed placeholders; the rest is
lower-cased words. Windows of :data:`WINDOW` template tokens of all documents
are hash-joined with those of the benchmark items, so a question is found
again with other numbers or names in it. A window carries the raw values of
its placeholders; along one alignment (document position minus item position)
the values must map one to one: the same item value always became the same
document value, and different ones stayed different.

A capital that begins a sentence does not tell a name from another word, so
texts are read twice: with such words as words, and with them as names. Each
reading of a document meets the same reading of the items, and a window is
held if one of its readings is.

Document windows are first only hashes, and meet the item windows in a
broadcast join when these are few (measured), else in a shuffle join. Slots
are looked at in documents that hold windows enough. Matches are aggregated
per document and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, frozen, text_or_empty

WINDOW = 5
#: A window needs so many tokens that are not placeholders.
MIN_WORDS = 2
#: Share of an item's windows that a document must hold.
MIN_COVERAGE = 0.6
#: Or so many tokens of an item in one run, whatever share of it they are.
MIN_RUN = 13

# Words that are units of measure, currency or time.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
         "kilometers kilometre kilometres centimeter centimeters millimeter millimeters g kg mg lb lbs oz gram grams "
         "kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes l ml liter liters litre litres gallon "
         "gallons quart quarts pint pints cup cups s sec secs second seconds min mins minute minutes h hr hrs hour "
         "hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur gbp percent "
         "mph kmh kph degree degrees celsius fahrenheit hz khz mhz ghz watt watts kw volt volts joule joules").split()

# Words that are numbers.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()

_NUMBER, _NAME, _UNIT = "#n", "#a", "#u"
_START = "\x01"  # marks a word that begins a sentence, where a capital says nothing
_INSIDE = "\x02"  # stands for the point or comma inside a number


def tokens(text: Column) -> Column:
    """Raw tokens: runs of letters and digits (a point or comma between two
    digits 0-9 is in the number); the first of a sentence marked."""
    marked = F.regexp_replace(text, r"(^|[.!?:;\n\u0022(]\s*)(\p{Lu})", "$1" + _START + "$2")
    whole = F.when(text.rlike("[0-9][.,][0-9]"), F.regexp_replace(marked, "([0-9])[.,](?=[0-9])", "$1" + _INSIDE)
                   ).otherwise(marked)
    return F.array_remove(F.split(whole, r"[^\p{L}\p{N}\x01\x02]+"), "")


def _canonical(t: Column) -> Column:
    """A raw token's place in the template. Most tokens are lower-case words:
    they are told by two comparisons, before any pattern is tried; then plain
    words that begin a sentence, by one pattern."""
    low = F.lower(t)
    kinds = F.when(t.isin(UNITS + NUMBER_WORDS), F.when(t.isin(UNITS), _UNIT).otherwise(_NUMBER)).otherwise(t)
    first = F.substring(low, 2, 1 << 30)
    return (F.when((t >= "a") & (t < "{") & (low == t), kinds)
            .when((t < "\x02") & t.rlike(rf"^{_START}[A-Za-z]+$"),
                  F.when(first.isin(NUMBER_WORDS), _NUMBER).otherwise(first))
            .when(t.rlike(r"^\x01?\p{N}") | low.isin(NUMBER_WORDS + [_START + w for w in NUMBER_WORDS]), _NUMBER)
            .when((low != t) & t.rlike(r"^\p{Lu}\p{Ll}+$"), _NAME)
            .when(low.isin(UNITS), _UNIT)
            .otherwise(F.translate(low, _START, "")))


def _named() -> Column:
    """The name's code where a capitalised word begins a sentence (numbers
    apart), else null."""
    name, number = F.xxhash64(F.lit(_NAME)), F.xxhash64(F.lit(_NUMBER))
    return F.zip_with("raw", "code", lambda t, c: F.when(
        (t < "\x02") & (c != number) & t.rlike(rf"^{_START}\p{{Lu}}\p{{Ll}}+$"), name))


def _starts(column: str) -> Column:
    """The first positions (from 0) of all windows; null if there is none."""
    last = F.size(column) - WINDOW
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))


def _hash(at: Column, codes: str = "code") -> Column:
    return F.xxhash64(*[F.get(codes, at + k) for k in range(WINDOW)])


def _tokenised(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``*keys, raw, code, named, alt``: raw tokens, the hashes of both readings
    and where they differ."""
    return (rows.select(*keys, tokens(text_or_empty(text_col)).alias("raw"))
            .select(*keys, "raw", F.transform("raw", lambda t: F.xxhash64(_canonical(t))).alias("code"))
            .select("*", _named().alias("named"))
            .select("*", F.zip_with("named", "code", lambda n, c: F.coalesce(n, c)).alias("alt")))


def _whole(raw: str | Column) -> Column:
    """Hash of all tokens of a text as they are, lower-cased."""
    return F.xxhash64(F.lit("whole"), F.transform(raw, lambda t: F.translate(F.lower(t), _START, "")))


def hashes(rows: DataFrame, keys: list[str], text_col: str, whole_tokens: int = 0) -> DataFrame:
    """``*keys, hash``: every window, as its hash alone; once more where a
    sentence-start capital in it can be read as a name. Texts of 1 to
    ``whole_tokens`` tokens also give that of their whole."""
    at, none = F.col("at"), F.array().cast("array<int>")
    # -1 stands for the whole text. (The places are no column of their own:
    # Spark would make a filter of one and read the texts twice.)
    places = F.concat(F.coalesce(_starts("code"), none),
                      F.when(F.col("whole").isNotNull(), F.array(F.lit(-1))).otherwise(none))
    each = (_tokenised(rows, keys, text_col)
            .select(*keys, "code", "named", "alt",
                    F.when(F.size("raw").between(1, whole_tokens), _whole("raw")).alias("whole"))
            .select(*keys, "code", "named", "alt", "whole", F.explode(places).alias("at")))
    differs = (at >= 0) & F.coalesce(*[F.get("named", at + k) for k in range(WINDOW)]).isNotNull()
    one = F.when(at >= 0, _hash(at)).otherwise(F.col("whole"))
    return each.select(*keys, F.explode(F.when(differs, F.array(one, _hash(at, "alt"))).otherwise(F.array(one))).alias("hash"))


def windows(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``*keys, reading, pos, hash, slots``: every window with at least
    :data:`MIN_WORDS` words; ``slots`` are its placeholders' raw values in
    order (null if it has none). Reading 0 takes capitalised words that begin
    a sentence as words, reading 1 as names."""
    both = _tokenised(rows, keys, text_col)
    plain = F.transform("raw", _canonical)
    named = F.zip_with(F.zip_with("code", "alt", lambda c, a: c != a), plain,
                       lambda n, t: F.when(n, _NAME).otherwise(t))
    readings = F.array(F.struct(F.lit(0).alias("reading"), F.col("code"), plain.alias("tpl")),
                       F.struct(F.lit(1).alias("reading"), F.col("alt").alias("code"), named.alias("tpl")))
    split = (both.select(*keys, "raw", F.explode(readings).alias("r"))
             .select(*keys, "raw", "r.reading", "r.code", "r.tpl"))

    def window(i: Column) -> Column:
        part, raw = F.slice("tpl", i + 1, WINDOW), F.slice("raw", i + 1, WINDOW)
        n_slots = F.size(F.filter(part, lambda t: t.startswith("#")))
        values = F.filter(F.zip_with(part, raw, lambda t, r: F.when(
            t.startswith("#"), F.concat(t, F.lower(F.translate(r, _START, ""))))), lambda v: v.isNotNull())
        return F.struct(i.alias("pos"), _hash(i).alias("hash"), n_slots.alias("n_slots"),
                        F.when(n_slots > 0, values).alias("slots"))

    return (split.select(*keys, "reading", F.explode(F.transform(_starts("tpl"), window)).alias("w"))
            .where(F.col("w.n_slots") <= WINDOW - MIN_WORDS)
            .select(*keys, "reading", "w.pos", "w.hash", "w.slots"))


def _run(positions: Column) -> Column:
    """Tokens of the longest run that windows at these positions cover. Windows
    that touch are one run: all tokens of one alignment match."""
    def step(seen: Column, at: Column) -> Column:
        first = F.when(at <= seen["last"] + WINDOW, seen["first"]).otherwise(at)
        return F.struct(first.alias("first"), at.alias("last"),
                        F.greatest(seen["best"], at + WINDOW - first).alias("best"))
    none = F.struct(F.lit(-2 * WINDOW).alias("first"), F.lit(-2 * WINDOW).alias("last"), F.lit(0).alias("best"))
    return F.aggregate(F.array_sort(positions), none, step, lambda seen: seen["best"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text",
          min_coverage: float = MIN_COVERAGE, min_run: int = MIN_RUN) -> DataFrame:
    """``id, text_key, item_id, coverage, verbatim``: one row per document and
    benchmark item that the document holds: ``min_coverage`` of its windows, or
    ``min_run`` of its tokens in one run.

    ``coverage`` is the share of the item's windows that the document holds in
    alignments with consistent slots, or without slots; ``verbatim`` is false
    if a placeholder has another value in the document. Both are those of the
    reading as words with consistent slots where that holds windows enough,
    else of all. Nulls are empty texts. An item of fewer than :data:`WINDOW`
    template tokens, or of hardly any word, has no window: it is found where it
    is the whole text, token by token in any case (coverage 1, verbatim); an
    item without a token is not looked for. Rows that repeat an id and a text are one document; ``text_key``
    tells apart rows that share an id (or have none).

    First all windows of all documents are joined by their hash alone; only
    documents that hold windows enough of an item are read again, for the
    positions and the slots.
    """
    texts = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")).distinct()
    items = frozen(windows(texts, ["item_id"], "item_text")
                   .select("item_id", "reading", F.col("pos").alias("item_pos"), "hash",
                           F.col("slots").alias("item_slots")))
    wanted = frozen(items.groupBy(F.col("item_id").alias("wanted_id"))
                    .agg(F.count_distinct("item_pos").alias("n_windows")))
    same_item = F.col("item_id").eqNullSafe(F.col("wanted_id"))
    short = (texts.select("item_id", tokens(text_or_empty("item_text")).alias("raw")).where(F.size("raw") > 0)
             .join(wanted, same_item, "left_anti")
             .select("item_id", _whole("raw").alias("hash"), F.size("raw").alias("n_tokens")).distinct())
    short = frozen(short)
    longest = short.agg(F.max("n_tokens")).first()[0] or 0

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       text_key(text_col).alias("text_key"))
    who = ["id", "text_key"]
    sought = items.select("item_id", "item_pos", "hash").distinct()
    n_sought = wanted
    if longest:
        sought = sought.unionByName(short.select("item_id", F.lit(0).alias("item_pos"), "hash"))
        n_sought = wanted.unionByName(short.select(F.col("item_id").alias("wanted_id"), F.lit(1).cast("long").alias("n_windows"))
                                      .distinct())
    likely = (hashes(rows, who, "text", longest)
              .join(broadcast_if_small(sought, 64), "hash")
              .groupBy(*who, "item_id").agg(F.collect_set("item_pos").alias("at"))
              .join(broadcast_if_small(n_sought, 32), same_item)
              .where((F.size("at") >= min_coverage * F.col("n_windows")) | (_run(F.col("at")) >= min_run))
              .select(F.col("id").alias("likely_id"), F.col("text_key").alias("likely_key")).distinct())
    likely = broadcast_if_small(frozen(likely), 32)
    again = rows.join(likely, F.col("id").eqNullSafe(F.col("likely_id"))
                      & (F.col("text_key") == F.col("likely_key")), "left_semi")
    found = (windows(again, who, "text")
             .join(broadcast_if_small(items, 128), ["reading", "hash"])
             .withColumn("shift", F.col("pos") - F.col("item_pos"))
             .withColumn("pairs", F.arrays_zip("item_slots", "slots")))
    # Per alignment: at most as many positions and pairs as the item has windows.
    aligned = (found.groupBy(*who, "item_id", "shift", "reading")
               .agg(F.collect_set("item_pos").alias("at"),
                    F.collect_set(F.when(F.col("item_slots").isNull(), F.col("item_pos"))).alias("free"),
                    F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    source = F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))
    target = F.array_distinct(F.transform("pairs", lambda p: p["slots"]))
    consistent = (F.size(source) == F.size("pairs")) & (F.size(target) == F.size("pairs"))
    same = F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    plain = (F.col("reading") == 0) & consistent
    # Windows without slots are held whatever became of the values around them.
    at = F.when(consistent, F.col("at")).otherwise(F.col("free"))
    held = (aligned.select(*who, "item_id", plain.alias("plain"), same.alias("same"), at.alias("at"))
            .select(*who, "item_id", "plain", "same", _run(F.col("at")).alias("run"),
                    F.explode("at").alias("item_pos"))
            .groupBy(*who, "item_id")
            .agg(F.size(F.collect_set(F.when(F.col("plain"), F.col("item_pos")))).alias("n_plain"),
                 F.min(F.when(F.col("plain"), F.col("same"))).alias("plain_verbatim"),
                 F.size(F.collect_set("item_pos")).alias("n_held"), F.min("same").alias("verbatim"),
                 F.max("run").alias("run")))
    enough = F.col("n_plain") >= min_coverage * F.col("n_windows")
    held = (held.join(broadcast_if_small(wanted, 32), same_item)
            .withColumn("verbatim", F.when(enough, F.col("plain_verbatim")).otherwise(F.col("verbatim")))
            .withColumn("coverage", F.when(enough, F.col("n_plain")).otherwise(F.col("n_held")) / F.col("n_windows"))
            .where((F.col("coverage") >= min_coverage) | (F.col("run") >= min_run))
            .select(F.col("id").alias(id_col), "text_key", "item_id", "coverage", "verbatim"))
    if not longest:
        return held
    whole = (again.select(*who, tokens(text_or_empty("text")).alias("raw")).where(F.size("raw").between(1, longest))
             .select(*who, _whole("raw").alias("hash")).distinct()
             .join(broadcast_if_small(short, 32), "hash"))
    return held.unionByName(whole.select(F.col("id").alias(id_col), "text_key", "item_id",
                                         F.lit(1.0).alias("coverage"), F.lit(True).alias("verbatim")))


def text_key(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col), F.crc32(text_or_empty(text_col)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The rows and columns of ``docs`` without those that hold an item."""
    found = frozen(leaks(docs, benchmark, id_col, text_col, **options)
                   .select(F.col(id_col).alias("__leak_id"), F.col("text_key").alias("__leak_key")).distinct())
    return docs.join(broadcast_if_small(found, 32),
                     F.col(id_col).eqNullSafe(F.col("__leak_id")) & (text_key(text_col) == F.col("__leak_key")),
                     "left_anti")
