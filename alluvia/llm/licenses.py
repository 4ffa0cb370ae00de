"""License scans by ordered signature rules, with DataFrame functions only and without a shuffle.

Base phrases are counted over words (runs of letters, digits and non-ASCII characters after A-Z are lower-cased). The rules are
regular expressions, built from families of licenses, their versions and the forms in which a license is named: an SPDX tag, a
notice, a URL, a title. Gates save work and lose nothing, as every match implies them: a text is matched only against rules of which
it holds a needle (one word of each name, the URL itself), and only if it holds one of the triggers at all. Matches are intervals of the lower-cased text. One that lies inside an interval of a
rule before it in the order (SPDX tag, notice, URL, title; with a version before without; longer before shorter) is suppressed.

Null and empty texts have no words, no places, empty labels and score 0. Texts are scanned whole; the only cost that is not linear is
in the number of license mentions inside one text. Repeated rows are scanned again, an empty table gives an empty result, and
columns that are not asked for are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.llm.words import free_name
from alluvia.queries.registry import table

# The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Families of licenses. Label, keyword, names, versions, URL.
FAMILIES = (
    ("agpl", "affero", ("gnu affero general public license", "affero general public license", "agpl"), ("3.0", "1.0"), "gnu.org/licenses/agpl"),
    ("lgpl", "lesser", ("gnu lesser general public license", "lesser general public license"), ("3.0", "2.1", "2.0"), "gnu.org/licenses/lgpl"),
    ("lgpl", "lgpl", ("gnu lgpl", "lgpl"), ("3.0", "2.1", "2.0"), ""),
    ("gpl", "general public", ("gnu general public license", "general public license"), ("3.0", "2.0", "1.0"), ""),
    ("gpl", "gpl", ("gnu gpl", "gpl"), ("3.0", "2.0", "1.0"), "gnu.org/licenses/gpl"),
    ("gfdl", "documentation", ("gnu free documentation license", "free documentation license"), ("1.3", "1.2", "1.1"), "gnu.org/licenses/fdl"),
    ("apache", "apache", ("apache software license", "apache license"), ("2.0", "1.1", "1.0"), "apache.org/licenses/license"),
    ("cc-by-nc-nd", "cc", ("creative commons attribution noncommercial noderivatives", "cc by nc nd"), ("4.0", "3.0", "2.0"), "creativecommons.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", "cc", ("creative commons attribution noncommercial sharealike", "cc by nc sa"), ("4.0", "3.0", "2.0"), "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc", "cc", ("cc by nc",), ("4.0", "3.0", "2.0"), "creativecommons.org/licenses/by-nc/"),
    ("cc-by-nd", "cc", ("cc by nd",), ("4.0", "3.0", "2.0"), "creativecommons.org/licenses/by-nd"),
    ("cc-by-sa", "cc", ("cc by sa",), ("4.0", "3.0", "2.0"), "creativecommons.org/licenses/by-sa"),
    ("cc-by", "cc", ("cc by",), ("4.0", "3.0", "2.5", "2.0"), "creativecommons.org/licenses/by/"),
    ("cc-by-nc", "creative", ("creative commons attribution noncommercial",), ("4.0", "3.0", "2.0"), ""),
    ("cc-by-nd", "creative", ("creative commons attribution noderivatives",), ("4.0", "3.0", "2.0"), ""),
    ("cc-by-sa", "creative", ("creative commons attribution sharealike",), ("4.0", "3.0", "2.0"), ""),
    ("cc-by", "creative", ("creative commons attribution",), ("4.0", "3.0", "2.5", "2.0"), ""),
    ("cc0", "cc0", ("cc0",), ("1.0",), "creativecommons.org/publicdomain/zero"),
    ("mit", "mit", ("mit license", "mit x11 license", "expat license"), (), "opensource.org/licenses/mit"),
    ("mit-0", "mit", ("mit no attribution", "mit 0 license"), (), ""),
    ("x11", "x11", ("x11 license",), (), ""),
    ("bsd-4-clause", "bsd", ("4 clause bsd license", "bsd 4 clause", "original bsd license"), (), "opensource.org/licenses/bsd-4-clause"),
    ("bsd-3-clause", "bsd", ("3 clause bsd license", "bsd 3 clause", "new bsd license", "modified bsd license"), (), "opensource.org/licenses/bsd-3-clause"),
    ("bsd-2-clause", "bsd", ("2 clause bsd license", "bsd 2 clause", "simplified bsd license"), (), "opensource.org/licenses/bsd-2-clause"),
    ("0bsd", "bsd", ("zero clause bsd", "0bsd"), (), ""),
    ("bsd", "bsd", ("bsd license", "berkeley software distribution license"), (), ""),
    ("isc", "isc", ("isc license",), (), "opensource.org/licenses/isc"),
    ("mpl", "mozilla", ("mozilla public license",), ("2.0", "1.1", "1.0"), "mozilla.org/mpl"),
    ("mpl", "mpl", ("mpl",), ("2.0", "1.1", "1.0"), ""),
    ("epl", "eclipse", ("eclipse public license",), ("2.0", "1.0"), "eclipse.org/legal/epl"),
    ("edl", "eclipse", ("eclipse distribution license",), ("1.0",), ""),
    ("cddl", "development and distribution", ("common development and distribution license",), ("1.1", "1.0"), ""),
    ("cpl", "common public", ("common public license",), ("1.0",), ""),
    ("eupl", "european union", ("european union public licence", "european union public license"), ("1.2", "1.1"), ""),
    ("artistic", "artistic", ("artistic license",), ("2.0", "1.0"), "opensource.org/licenses/artistic"),
    ("afl", "academic free", ("academic free license",), ("3.0", "2.1"), ""),
    ("osl", "open software", ("open software license",), ("3.0", "2.1"), ""),
    ("bsl-1.0", "boost", ("boost software license",), ("1.0",), "boost.org/license"),
    ("zlib", "zlib", ("zlib license", "zlib libpng license"), (), ""),
    ("unlicense", "unlicense", ("the unlicense", "unlicense"), (), "unlicense.org"),
    ("wtfpl", "wtfpl", ("wtfpl",), ("2.0",), ""),
    ("ofl", "open font", ("sil open font license", "open font license"), ("1.1", "1.0"), "scripts.sil.org/ofl"),
    ("odbl", "open database", ("open database license",), ("1.0",), "opendatacommons.org/licenses/odbl"),
    ("odc-by", "open data commons", ("open data commons attribution license",), ("1.0",), "opendatacommons.org/licenses/by"),
    ("pddl", "public domain", ("public domain dedication and license",), ("1.0",), "opendatacommons.org/licenses/pddl"),
    ("psf", "python", ("python software foundation license", "psf license"), ("2.0",), "docs.python.org/license"),
    ("postgresql", "postgresql", ("postgresql license",), (), "opensource.org/licenses/postgresql"),
    ("php", "php", ("php license",), ("3.01", "3.0"), ""),
    ("ncsa", "ncsa", ("university of illinois ncsa open source license", "ncsa open source license"), (), ""),
    ("openssl", "openssl", ("openssl license",), (), ""),
    ("lppl", "latex", ("latex project public license",), ("1.3", "1.2"), "latex-project.org/lppl"),
    ("ms-pl", "microsoft", ("microsoft public license",), (), ""),
    ("ms-rl", "microsoft", ("microsoft reciprocal license",), (), ""),
    ("cecill", "cecill", ("cecill free software license agreement", "cecill"), ("2.1", "2.0"), ""),
    ("busl", "business source", ("business source license",), ("1.1",), ""),
    ("sspl", "server side", ("server side public license",), ("1.0",), ""),
    ("elastic", "elastic", ("elastic license",), ("2.0",), ""),
    ("w3c", "w3c", ("w3c software notice and license", "w3c license"), (), ""),
    ("vim", "vim", ("vim license",), (), ""),
    ("mulan", "mulan", ("mulan permissive software license",), ("2.0",), ""),
    ("upl", "universal permissive", ("universal permissive license",), ("1.0",), ""),
)
# Words that say little about which license a name names, and parts of names and URLs that serve several as triggers.
COMMON = set("license licence public software free open source general project the and of distribution foundation".split())
STEMS = ("licen", "creative", "gpl", "mpl", "bsd", "eclipse", "cc0", "cecill", "latex")
#: The forms in their order, with the confidence that each gives.
FORMS = (("tag", 1.0), ("notice", 0.95), ("url", 0.9), ("title", 0.75))
BASE_CONFIDENCE = 0.5

_GRANTS = "(?:licen[cs]ed|released|distributed|available|published|provided|covered|offered|shared|redistributed)"


@dataclass(frozen=True)
class Signature:
    """``order`` decides which of two overlapping matches stays: the lower one. Every match holds one of ``needles``."""

    label: str
    keyword: str  # words that go with the rule; it gates nothing
    pattern: str
    order: int
    confidence: float
    needles: tuple[str, ...] = ()


def spelled(name: str) -> str:
    """Any separators between the words of a name; what may follow it is left to the rule."""
    return r"\b" + r"[^0-9a-z]+".join(name.split())


def needle_of(name: str) -> str:
    """The word of a name that says most."""
    words = name.split()
    return max([w for w in words if w not in COMMON] or words, key=len)


def triggers(families) -> tuple[str, ...]:
    """Parts of words such that every name and URL, every tag and every base phrase holds one of them."""
    made = {"licen"}
    for _, _, names, _, url in families:
        for said in (*names, *([url] if url else [])):
            words = re.findall("[0-9a-z]+", said)
            made.add(next((t for t in STEMS if any(t in w for w in words)), max(words, key=len)))
    made.update("licen" if "license" in p.split() else needle_of(p) for p, _ in PHRASES)
    return tuple(sorted(made))


def versioned(version: str) -> str:
    whole, _, part = version.partition(".")
    tail = rf"(?:\.{part})?" if part == "0" else rf"\.{part}"
    apart = r"\b(?:[^0-9a-z]+(?:licen[cs]e|international|unported|public))*[^0-9a-z]{1,3}(?:version[^0-9a-z]{1,3}|v\.?\s?)?"
    return rf"(?:{apart}|v?){whole}{tail}(?![0-9.]*[0-9])"  # the version may be joined to the name: gplv3


def signatures(families=FAMILIES) -> list[Signature]:
    """The rules: every name of every family, in every form, with and without each version."""
    rules = []
    for label, keyword, names, versions, url in families:
        name = "(?:" + "|".join(map(spelled, names)) + ")"
        for version in (*versions, ""):
            full = f"{label}-{version}" if version else label
            rank = 0 if version else 1
            after = versioned(version) if version else r"(?:\b|(?=v?[0-9]))" if versions else r"\b"
            tag = full.replace(".", r"\.")
            patterns = {
                "tag": rf"spdx-license-identifier:\s*{tag}(?:-only|-or-later)?(?![0-9a-z.-])",
                "notice": rf"\b{_GRANTS}\b[^.\n]{{0,40}}?\bunder\b[^.\n]{{0,30}}?{name}{after}",
                "url": url.replace(".", r"\.") + (rf"[^\s]{{0,3}}{version.replace('.', '[.]')}" if version else "") if url else "",
                "title": f"{name}{after}",
            }
            for place, (form, confidence) in enumerate(FORMS):
                if patterns[form]:
                    words, needles = {
                        "tag": ("spdx", ("spdx-license-identifier:",)), "url": (" ".join(re.findall("[0-9a-z]+", url)), (url,)),
                    }.get(form, (keyword, tuple(dict.fromkeys(map(needle_of, names)))))
                    rules.append(Signature(full, words, patterns[form], 2 * place + rank, confidence, needles))
    return rules


#: What a text must hold to be looked at; one of two letters is a trigger only as the start of a name.
TRIGGERS = triggers(FAMILIES)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = "".join(chr(c) for c in range(0x80) if not (chr(c).isdigit() or chr(c).isalpha()))


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def apart(text: Column) -> Column:
    """Lower-cased, with a space for every character that no word has."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER + _APART, _LOWER + " " * len(_APART))


def spaced(words: Column) -> Column:
    """Every word between spaces of its own: `` w1  w2 ``; empty when there is none."""
    return F.when(F.size(words) == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")))


def needle(phrase: str) -> str:
    return " " + "  ".join(phrase.split()) + " "


def places(words: Column, phrase: str) -> Column:
    """How often the phrase's words stand consecutively."""
    wanted = needle(phrase)
    return ((F.length(words) - F.length(F.replace(words, F.lit(wanted), F.lit("")))) / len(wanted)).cast("long")


def count_words(words: Column) -> Column:
    gaps = F.length(words) - F.length(F.replace(words, F.lit("  "), F.lit(" ")))
    return F.when(words == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def detections(lower: Column, rules: Column) -> Column:
    """Intervals of all matches of the given rules."""
    def of_rule(r):
        found = F.regexp_extract_all(lower, r["pattern"], F.lit(0))
        gaps = F.split(lower, r["pattern"], -1)
        walked = F.aggregate(
            F.arrays_zip(gaps.alias("g"), found.alias("m")),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
            lambda s, x: F.struct(
                (s["at"] + F.length(x["g"]) + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
                F.when(x["m"].isNull(), s["spans"]).otherwise(F.concat(s["spans"], F.array(F.struct(
                    (s["at"] + F.length(x["g"])).alias("start"), (s["at"] + F.length(x["g"]) + F.length(x["m"])).alias("end"))))).alias("spans")))
        return F.transform(walked["spans"], lambda i: F.struct(
            i["start"].alias("start"), i["end"].alias("end"), r["order"].alias("order"), r["label"].alias("label"),
            r["confidence"].alias("confidence")))

    return F.flatten(F.transform(rules, of_rule))


def surviving(found: Column) -> Column:
    """Matches that do not lie inside a match of a rule before theirs, or inside a longer one of the same order."""
    def inside(d, e):
        longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
        return (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & ((e["order"] < d["order"]) | ((e["order"] == d["order"]) & longer))

    return F.filter(found, lambda d: ~F.exists(found, lambda e: inside(d, e)))


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, into: str = "license", families=FAMILIES) -> DataFrame:
    """The columns ``keep`` and a struct ``into``: n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    keep = docs.columns if keep is None else keep
    lower, plain, words, met, found = (free_name(docs, n) for n in ("_lower", "_plain", "_words", "_met", "_found"))
    rows = docs.select(*(docs[c] for c in keep), docs[text].alias(lower), apart(docs[text]).alias(plain))
    gate = F.lit(False)
    for t in sorted(triggers(families), key=len, reverse=True):
        held = F.contains(F.col(plain), F.lit(t))
        gate = gate | (held & F.rlike(F.col(plain), F.lit("cc[^0-9a-z]")) if t == "cc" else held)
    listed = F.array_remove(F.split(F.col(plain), " "), "")
    total_words = free_name(docs, "_total")
    rows = rows.withColumn(plain, F.struct(gate.alias("gate"), listed.alias("words")))
    # Only gated texts are looked at again.
    rows = rows.withColumn(total_words, F.size(f"{plain}.words").cast("long"))
    rows = rows.withColumn(words, F.when(F.col(f"{plain}.gate"), spaced(F.col(f"{plain}.words"))).otherwise(F.lit("")))
    rows = rows.withColumn(lower, F.when(F.col(f"{plain}.gate"), lowered(F.col(lower))).otherwise(F.lit(""))).drop(plain)
    by_needles = defaultdict(list)
    for s in signatures(families):
        by_needles[s.needles].append(F.struct(F.lit(s.pattern).alias("pattern"), F.lit(s.order).alias("order"), F.lit(s.label).alias("label"),
                                              F.lit(s.confidence).alias("confidence")))
    groups = F.array(*(F.struct(F.array(*map(F.lit, needles)).alias("needles"), F.array(*own).alias("rules")) for needles, own in by_needles.items()))
    near = F.filter(groups, lambda g: F.exists(g["needles"], lambda n: F.contains(F.col(lower), n)))
    rules = F.flatten(F.transform(near, lambda g: g["rules"]))
    none = F.array().cast("array<struct<start:int,end:int,order:int,label:string,confidence:double>>")
    rows = rows.withColumn(met, F.when(F.col(lower) != "", detections(F.col(lower), F.filter(
        rules, lambda r: F.rlike(F.col(lower), r["pattern"])))).otherwise(none))
    rows = rows.withColumn(found, F.when(F.size(met) > 1, surviving(F.col(met))).otherwise(F.col(met)))
    w = F.col(words)
    counts = [places(w, p) for p, _ in PHRASES]
    total = sum(counts[1:], counts[0])
    before = lambda p: count_words(F.substr(w, F.lit(1), F.instr(w, needle(p)) - 1))
    after = lambda p: count_words(F.substr(F.reverse(w), F.lit(1), F.instr(F.reverse(w), needle(p)[::-1]) - 1))
    firsts = [F.when(F.contains(w, F.lit(needle(p))), before(p)) for p, _ in PHRASES]
    lasts = [F.when(F.contains(w, F.lit(needle(p))), F.col(total_words) - after(p) - len(p.split())) for p, _ in PHRASES]
    base = F.array_sort(F.array_compact(F.array(*(F.when(F.contains(w, F.lit(needle(p))), F.lit(label)) for p, label in PHRASES))))
    spans = F.col(found)
    score = F.greatest(F.coalesce(F.array_max(F.transform(spans, lambda d: d["confidence"])), F.lit(0.0)),
                       F.when(F.size(base) > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0)))
    made = F.struct(
        F.col(total_words).alias("n_words"), total.alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform(spans, lambda d: d["label"]))), ",").alias("labels"),
        score.alias("score"), spans.alias("spans"))
    return rows.select(*(F.col(f"`{c}`") for c in keep), made.alias(into))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("doc_id", *(F.col(f"license.{c}") for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")))
