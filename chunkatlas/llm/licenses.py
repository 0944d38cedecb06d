"""Licence scans in DataFrame operations only: Dice coefficient of word bigrams against templates.

A unit is a line of a text, or the whole text. Its normalised words' distinct bigrams are held against each
template whose size could reach the threshold: with a threshold t, a template of m bigrams and a unit of n
can only match if t / (2 - t) * m <= n <= (2 - t) / t * m.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import packed, unpacked

#: Short notices by which texts name their licence.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-3-clause": "Licensed under the BSD 3-Clause License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
}
THRESHOLD = 0.8


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is its own pair."""
    def of(w: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.array_join(F.slice(w, i, 2), " "))
        return F.when(F.size(w) > 1, F.array_distinct(pairs)).otherwise(w)

    # A one-element array binds the words once; within a lambda an expression is computed for each element.
    return F.get(F.transform(F.array(words), of), F.lit(0))


def needed_words(templates: dict[str, str], threshold: float = THRESHOLD) -> list[str]:
    """Words of which a unit has at least one if it reaches the threshold with any template.

    Such a unit shares at least the fraction t / (2 - t) of the template's bigrams, so of any words that touch
    more than the rest of them it has one. Long words are taken first.
    """
    out: set[str] = set()
    for notice in templates.values():
        words = [w for w in re.split(r"[\W_]+", notice.lower()) if w]
        grams = set(zip(words, words[1:])) if len(words) > 1 else {(w, w) for w in words}
        spare, touched = len(grams) * (1 - threshold / (2 - threshold)) + 1e-9, set()
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if len(touched) > spare:
                break
            out.add(word)
            touched |= {g for g in grams if word in g}
    return sorted(out)


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """Add ``licences``: an array of (line, licence, dice) of all units that reach the threshold, in order.

    line counts from 0; the whole text is line -1, unless it is a single line. Of templates that reach it
    on one unit, the likest counts, the first name on ties. Null and empty texts have none. Each row is
    handled where it is: no exchange, and equal rows get equal results. Templates are few and short. Only units
    with a word that every match needs are split into words; no unit is left out for its length. All columns of
    ``docs`` stay, but for one named ``licences``.
    """
    own = templates or TEMPLATES
    table = F.array(*[F.struct(F.lit(name).alias("name"), bigrams(normal_words(F.lit(notice))).alias("grams"))
                      for name, notice in sorted(own.items())])
    lo, hi = F.lit(threshold / (2 - threshold)), F.lit((2 - threshold) / threshold)
    # The characters are letters and digits only.
    needed = "|".join(needed_words(own, threshold))
    kept = docs.drop("licences")
    content = F.coalesce("text", F.lit(""))
    lines = F.when(F.lower(content).rlike(needed), F.split(content, "\n", -1))
    whole = F.when(F.size("_lines") > 1, F.array(F.struct(F.lit(-1).alias("line"), content.alias("unit"))))
    numbered = F.transform("_lines", lambda x, i: F.struct(i.alias("line"), x.alias("unit")))
    units = F.filter(F.concat(F.coalesce(whole, F.array().cast("array<struct<line:int,unit:string>>")), numbered),
                     lambda u: F.lower(u["unit"]).rlike(needed))
    step = packed(kept, text).withColumn("_lines", lines).withColumn("_units", units)
    step = step.withColumn("_grams", F.transform("_units", lambda u: F.struct(
        u["line"].alias("line"), bigrams(normal_words(u["unit"])).alias("grams"))))
    step = step.withColumn("_table", F.when(F.size("_grams") > 0, table))

    def best(u: Column) -> Column:
        n = F.size(u["grams"])
        fit = F.filter(F.col("_table"), lambda t: (n >= lo * F.size(t["grams"])) & (n <= hi * F.size(t["grams"])))
        scored = F.transform(fit, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(u["grams"], t["grams"])) / (n + F.size(t["grams"]))).alias("less"),
            t["name"].alias("name")))
        return F.struct(u["line"].alias("line"), F.array_min(scored).alias("best"))

    found = F.filter(F.transform("_grams", best), lambda x: F.coalesce(-x["best"]["less"] >= threshold, F.lit(False)))
    out = F.transform(found, lambda x: F.struct(
        x["line"].alias("line"), x["best"]["name"].alias("licence"), (-x["best"]["less"]).alias("dice")))
    none = F.array().cast("array<struct<line:int,licence:string,dice:double>>")
    rows = step.withColumn("licences", F.coalesce(out, none))
    return unpacked(rows, kept.withColumn("licences", none), text, licences=F.col("licences"))
