"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

A text becomes a list of words (runs of letters, digits and non-ASCII characters, lower-cased), and beside it its template: numbers,
names (capitalised inside a sentence) and units (after a number) give way to typed placeholders. Windows of template words
are hashed and joined with the windows of the benchmark, so a question that was given other numbers and names still meets its
original. Aligned windows of one document and item form an occurrence. Its slots must be consistent: the values of the item
and of the document must map one to one onto each other, otherwise the occurrence is chance.

A document leaks an item when consistent occurrences cover ``min_share`` of the item's windows, or when one verbatim occurrence runs
over ``min_words`` words. Items below ``window`` words are one window of their own length; templates below ``shortest`` words say too
little to be searched. A template's window needs ``literals`` words (half of a short one's) that are not placeholders.

Beside its templates every item is searched by its exact words (lower-cased, nothing typed, of any length), so verbatim copies of items
made of numbers and names, of short items and of items behind a colon are found. A whole copy always counts; a part counts by the
same shares, unless the template met the item there with values that do not map one to one. Where both find an item, the template's
figures are reported.

Benchmark windows are broadcast only when they are counted and at most ``broadcast_rows``; beyond that the join shuffles. Texts stay
where they are: windows leave a document as (id, hash of the text, position, hash), and only texts that met a window are read again.

Null and empty texts leak nothing; items without an id are not searched. Documents with one id are told apart by their text; equal rows report once. An empty
benchmark or an empty table gives an empty result; columns that are not asked for are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.llm.licenses import apart
from alluvia.llm.store import stored
from alluvia.queries.registry import table

# Marks of typed words (private characters, so they stay part of their word), and the units.
NAME, UNIT, POINT = "", "", ""
UNITS = """mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre
    kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes ml cl l liter liters litre
    litres gallon gallons pint pints cup cups s sec second seconds min minute minutes h hour hours day days week weeks month months year
    years hz khz mhz ghz w kw mw v kv a j kj cal kcal n pa kpa c f k percent usd eur gbp dollar dollars euro euros cent cents
    b kb mb gb tb px mph kmh""".split()


@dataclass(frozen=True)
class Settings:
    window: int = 8
    shortest: int = 5
    literals: int = 4
    min_share: float = 0.5
    min_words: int = 13
    broadcast_rows: int = 1_000_000


def marked(text: Column) -> Column:
    """The text with a mark before every name and unit, and inside numbers one mark for their points."""
    names = ("([\\p{Ll},;:] )(\\p{Lu}\\p{Ll})", f"$1{NAME}$2")
    out = F.regexp_replace(F.coalesce(text, F.lit("")), *map(F.lit, names))
    out = F.regexp_replace(out, *map(F.lit, names))  # neighbours share the character between them
    out = F.when(F.rlike(out, F.lit("[0-9]")), F.regexp_replace(
        F.regexp_replace(out, F.lit("([0-9])[.,]([0-9])"), F.lit(f"$1{POINT}$2")),
        F.lit(f"([0-9] ?)((?:{'|'.join(UNITS)})\\b)"), F.lit(f"$1 {UNIT}$2"))).otherwise(out)
    return out


def said(text: Column) -> Column:
    """The words of a text with single or wider gaps of spaces between them."""
    return apart(F.lower(marked(text)))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(said(text), " "), "")


def template(words: Column) -> Column:
    """Placeholders for the typed words of a text as ``said`` gives it."""
    typed = F.regexp_replace(words, F.lit(f"{NAME}[^ ]*"), F.lit("#name"))
    typed = F.regexp_replace(typed, F.lit(f"{UNIT}[^ ]*"), F.lit("#unit"))
    typed = F.regexp_replace(typed, F.lit("(?<![^ ])[0-9][^ ]*"), F.lit("#num"))
    return F.when(F.rlike(words, F.lit(f"[0-9{NAME}{UNIT}]")), typed).otherwise(words)


def with_kinds(rows: DataFrame, text: str, *keep: Column | str) -> DataFrame:
    """``keep``, the words ``kinds`` of each text's template, and whether any of them is ``typed``."""
    told = rows.select(*keep, template(said(F.col(text))).alias("told"))
    names = told.columns[:-1]
    return told.select(*names, F.array_remove(F.split("told", " "), "").alias("kinds"), F.contains("told", F.lit("#")).alias("typed"))


def hashes_of(words: Column) -> Column:
    """A hash of each word: windows are then hashes of eight numbers, whatever the words' lengths."""
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(hashed: Column, size: int) -> Column:
    """Hash of the window of words at every position."""
    at = F.sequence(F.lit(1), F.size(hashed) - size + 1)
    return F.when(F.size(hashed) < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.xxhash64(F.slice(hashed, i, size), F.lit(size))))


def typed_windows(kinds: Column, hashed: Column, size: int, literals: int) -> Column:
    """The same over a template; null where too few words are literal."""
    need = min(literals, (size + 1) // 2)
    literal = lambda w: F.size(F.filter(w, lambda x: ~F.startswith(x, F.lit("#"))))
    at = F.sequence(F.lit(1), F.size(hashed) - size + 1)
    return F.when(F.size(hashed) < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.when(literal(F.slice(kinds, i, size)) >= need, F.xxhash64(F.slice(hashed, i, size), F.lit(size)))))


def exact_words(text: Column) -> Column:
    return F.array_remove(F.split(apart(F.lower(text)), " "), "")


def item_windows(items: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """(item, edition, exact, size, words, windows, n_windows, typed) of the benchmark, by templates and by exact words.

    ``typed`` says whether the item has a placeholder.
    """
    plain = items.select(F.col(key).alias("item"), exact_words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    plain = plain.withColumn("edition", F.xxhash64("words", F.lit("exact"))).dropDuplicates(["item", "edition"])
    rows = with_kinds(items, text, F.col(key).alias("item"), words_of(F.col(text)).alias("words"))
    rows = rows.filter(F.size("words") >= settings.shortest).withColumn("edition", F.xxhash64("words")).dropDuplicates(["item", "edition"])
    plain = plain.withColumn("hashed", hashes_of(F.col("words")))
    rows = rows.withColumn("hashed", hashes_of(F.col("kinds")))
    parts = []
    for size in range(settings.shortest, settings.window + 1):
        own = rows.filter(F.size("words") >= size if size == settings.window else F.size("words") == size)
        parts.append(own.select("item", "edition", F.lit(False).alias("exact"), F.lit(size).alias("size"), "words", "typed",
                                typed_windows(F.col("kinds"), F.col("hashed"), size, settings.literals).alias("windows")))
    for size in range(1, settings.window + 1):
        own = plain.filter(F.size("words") >= size if size == settings.window else F.size("words") == size)
        parts.append(own.select("item", "edition", F.lit(True).alias("exact"), F.lit(size).alias("size"), "words", F.lit(False).alias("typed"),
                                windows(F.col("hashed"), size).alias("windows")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.withColumn("n_windows", F.size(F.array_distinct(F.array_compact("windows"))))


def version(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def met_windows(texts: DataFrame, hashes: DataFrame, sizes: list[tuple[bool, int]], settings: Settings) -> DataFrame:
    """(id, version, at, item, edition, item_at, size) of every window of a text that is one of the benchmark's.

    Texts are read once: the windows of all sizes, by exact words and, where a text has placeholders, by its template, stand in one
    array one after the other. A text without placeholders is its own template, so its exact windows count as both.
    """
    columns = ["id", "version", "at", "item", "edition", "item_at", "size"]
    if not sizes:
        return texts.select("id", "version", F.lit(0).alias("at")).join(hashes, F.lit(False)).select(columns)
    rows = texts.select("id", "version", exact_words(F.col("text")).alias("words"), template(said(F.col("text"))).alias("told"))
    rows = rows.withColumn("typed", F.contains("told", F.lit("#")))
    rows = rows.withColumn("kinds", F.when(F.col("typed"), F.array_remove(F.split("told", " "), "")).otherwise(F.array().cast("array<string>")))
    rows = rows.select("id", "version", "typed", "kinds", hashes_of(F.col("words")).alias("hashed"), hashes_of(F.col("kinds")).alias("hashed_kinds"))
    parts = [(exact, size) for size in sorted({n for _, n in sizes}) for exact in (True, False)
             if exact or (False, size) in sizes]
    made = [windows(F.col("hashed"), n) if exact else typed_windows(F.col("kinds"), F.col("hashed_kinds"), n, settings.literals) for exact, n in parts]
    rows = rows.select("id", "version", "typed", *(w.alias(f"w{k}") for k, w in enumerate(made)))
    lengths = [F.size(f"w{k}") for k in range(len(parts))]
    ends = F.array(*(sum(lengths[1:k + 1], lengths[0]) for k in range(len(parts))))
    placed = rows.select("id", "version", "typed", ends.alias("ends"), F.posexplode(F.concat(*(F.col(f"w{k}") for k in range(len(parts))))).alias("pos", "hash"))
    found = placed.join(hashes, "hash").withColumn("part", F.size(F.filter("ends", lambda e: e <= F.col("pos"))))
    found = found.withColumn("at", F.col("pos") - F.when(F.col("part") == 0, 0).otherwise(F.get("ends", F.col("part") - 1)))
    by_words = F.get(F.array(*(F.lit(exact) for exact, _ in parts)), F.col("part"))
    same_size = F.get(F.array(*(F.lit(n) for _, n in parts)), F.col("part")) == F.col("size")
    return found.filter(same_size & (F.col("exact") == by_words) | same_size & by_words & ~F.col("exact") & ~F.col("typed")).select(columns)


def leaks(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_key, matched, n_windows, verbatim, n_slots) of every document and item that it leaks."""
    return leaking_texts(docs, items, settings, key, text, item_key, item_text).groupBy(
        F.col("id").alias(key), F.col("item").alias(item_key)).agg(
        F.max("matched").alias("matched"), F.max("n_windows").alias("n_windows"), F.max("verbatim").alias("verbatim"),
        F.max("n_slots").alias("n_slots"))


def leaking_texts(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, version, item, matched, n_windows, verbatim, n_slots) of every leak."""
    item_rows = stored(item_windows(items, settings, item_key, item_text), "leak-items")
    hashes = stored(
        item_rows.select("item", "edition", "exact", "size", F.posexplode("windows").alias("item_at", "hash")).filter("hash IS NOT NULL")
        .groupBy("item", "edition", "exact", "size", "hash").agg(F.min("item_at").alias("item_at")), "leak-windows")
    sizes = sorted((r["exact"], r["size"]) for r in hashes.select("exact", "size").distinct().collect())  # at most two for each of ``window``
    if hashes.count() <= settings.broadcast_rows:
        hashes = F.broadcast(hashes)
    texts = docs.select(F.col(key).alias("id"), version(F.col(text)).alias("version"), F.col(text).alias("text"))
    met = met_windows(texts, hashes, sizes, settings)
    aligned = stored(
        met.groupBy("id", "version", "item", "edition", "size", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.array_sort(F.collect_set("item_at")).alias("item_ats")), "leak-met")  # at most the windows of one item
    told = aligned.join(item_rows.select("item", "edition", "exact", "n_windows", "typed"), ["item", "edition"])
    covered = lambda ats, size: F.array_distinct(F.flatten(F.transform(ats, lambda i: F.sequence(i + 1, i + size))))
    # Without placeholders in the item, equal templates are equal words.
    literal = told.filter(~F.col("typed")).select(
        "id", "version", "item", "edition", "exact", "n_windows", "item_ats", F.size(covered(F.col("item_ats"), F.col("size"))).alias("n_covered"),
        F.lit(0).alias("n_slots"), F.lit(True).alias("verbatim"))
    # The others are looked at again, in the texts that met them, for their words at the slots.
    # Stored, so that the planner knows how few they are before it would deal out all texts.
    open_rows = stored(told.filter("typed"), "leak-typed")
    again = texts.alias("t").join(
        open_rows.select(F.col("id").alias("met_id"), F.col("version").alias("met_version")).distinct().alias("m"),
        F.col("t.id").eqNullSafe(F.col("m.met_id")) & (F.col("t.version") == F.col("m.met_version")), "left_semi")
    again = again.dropDuplicates(["id", "version"]).select("id", "version", words_of(F.col("text")).alias("words"))
    pairs = open_rows.alias("a").join(again.alias("w"), F.col("a.id").eqNullSafe(F.col("w.id")) & (F.col("a.version") == F.col("w.version")))
    pairs = pairs.select("a.*", "w.words").join(item_rows.select("item", "edition", F.col("words").alias("item_words")), ["item", "edition"])
    typed = lambda w: F.startswith(w, F.lit(NAME)) | F.startswith(w, F.lit(UNIT)) | F.rlike(w, F.lit("^[0-9]"))
    places = covered(F.col("item_ats"), F.col("size"))
    values = F.array_distinct(F.transform(
        F.filter(places, lambda i: typed(F.get("item_words", i - 1))),
        lambda i: F.struct(F.get("item_words", i - 1).alias("theirs"), F.get("words", i - 1 + F.col("shift")).alias("ours"))))
    slots = stored(pairs.select(
        "id", "version", "item", "edition", "exact", "n_windows", "item_ats", F.size(places).alias("n_covered"), values.alias("slots")), "leak-slots")
    one_to_one = (F.size(F.array_distinct(F.transform("slots", lambda s: s["theirs"]))) == F.size("slots")) & (
        F.size(F.array_distinct(F.transform("slots", lambda s: s["ours"]))) == F.size("slots"))
    occurrences = literal.unionByName(slots.filter(one_to_one).select(
        "id", "version", "item", "edition", "exact", "n_windows", "item_ats", "n_covered", F.size("slots").alias("n_slots"),
        (~F.exists("slots", lambda s: s["theirs"] != s["ours"])).alias("verbatim")))
    per_window = occurrences.withColumn("item_at", F.explode("item_ats")).groupBy("id", "version", "item", "edition", "exact", "n_windows", "item_at").agg(
        F.max("verbatim").alias("verbatim"), F.max("n_slots").alias("n_slots"),
        F.max(F.when(F.col("verbatim"), F.col("n_covered")).otherwise(0)).alias("longest"))
    found = per_window.groupBy("id", "version", "item", "edition", "exact", "n_windows").agg(
        F.count(F.lit(1)).alias("matched"), F.min("verbatim").alias("verbatim"), F.max("n_slots").alias("n_slots"), F.max("longest").alias("longest"))
    leaked = (F.col("matched") >= settings.min_share * F.col("n_windows")) | (F.col("longest") >= settings.min_words)
    names = ("matched", "n_windows", "verbatim", "n_slots")
    judged = found.filter(leaked).select("id", "version", "item", "exact", F.lit(False).alias("chance"), *names)
    chance = slots.filter(~one_to_one).select("id", "version", "item", F.lit(False).alias("exact"), F.lit(True).alias("chance")).distinct()
    # Few rows: those that leak, and those that the template judged to be chance.
    judged = judged.unionByName(chance, allowMissingColumns=True).groupBy("id", "version", "item").agg(
        F.max("chance").alias("chance"), F.max(F.when(F.col("exact"), F.col("matched") == F.col("n_windows"))).alias("whole"),
        *(F.max(F.when(F.col("exact") == exact, F.col(n))).alias(f"{kind}_{n}") for exact, kind in ((False, "typed"), (True, "exact")) for n in names))
    judged = judged.filter(F.col("typed_matched").isNotNull() | F.col("whole") | (F.col("exact_matched").isNotNull() & ~F.col("chance")))
    return judged.select("id", "version", "item", *(F.coalesce(f"typed_{n}", f"exact_{n}").alias(n) for n in names))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
