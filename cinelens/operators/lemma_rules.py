"""Lemmas by suffix rules, an exception list and a dictionary.

A word's lemma is the shortest of the forms that the dictionary knows: the
word itself and what the rules make of its ending, or, for an irregular word,
what the exception list names. Where none is known the rules are applied to
the new forms again. The work is done once per distinct word; the result is a
lemma table like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .lookup import local_table

# --- fixed values: noun endings of the published dictionary's morphology (old ending, new ending) ---
NOUN_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
              ("men", "man"), ("ies", "y")]
# ------------------------------------------------------------------------------------------------


def detached(forms: Column, rules=NOUN_RULES) -> Column:
    """All forms that one application of the rules makes, in the order of forms and rules."""
    def of(form):
        made = [F.when(form.endswith(old), F.concat(F.left(form, F.length(form) - len(old)), F.lit(new))) for old, new in rules]
        return F.filter(F.array(*made), lambda x: x.isNotNull())
    return F.flatten(F.transform(forms, of))


def rule_lemmas(tokens: DataFrame, dictionary: DataFrame, rules=NOUN_RULES, exceptions: dict | None = None,
                col: str = "token") -> DataFrame:
    """``(token, lemma)`` of every distinct token that has a lemma in ``dictionary`` (its first column holds the words).

    Of equally short forms the first one made counts. Irregular words
    (``exceptions``: word -> forms) are looked up there alone. Tokens without
    any known form are left out: ``lemmatize`` keeps them as they are. Words
    whose forms are unknown go into another round, as long as a rule applies.
    """
    spark = tokens.sparkSession
    words = tokens.select(F.col(col).alias("token")).where(F.col(col).isNotNull()).distinct()
    known = checkpointed(dictionary.select(F.col(dictionary.columns[0]).alias("form")).distinct())
    irregular = local_table(spark, sorted((w, [w, *forms]) for w, forms in (exceptions or {}).items()), "word string, forms array<string>")
    own = words.join(irregular, F.col("token") == F.col("word"), "left")
    state = checkpointed(own.select(
        "token", F.coalesce("forms", F.concat(F.array("token"), detached(F.array("token"), rules))).alias("forms"),
        F.when(F.col("forms").isNull(), detached(F.array("token"), rules)).otherwise(F.array().cast("array<string>")).alias("made")))
    found = None
    while True:
        spelt = state.select("token", F.posexplode("forms").alias("at", "form"))
        hits = spelt.join(known, "form").groupBy("token").agg(F.min(F.struct(F.length("form"), "at", "form")).alias("best"))
        part = checkpointed(hits.select("token", F.col("best.form").alias("lemma")))
        found = part if found is None else found.unionAll(part)
        more = detached(F.col("made"), rules)
        state = checkpointed(state.where(F.size("made") > 0).join(part, "token", "left_anti").select(
            "token", more.alias("forms"), more.alias("made")).where(F.size("made") > 0))
        if state.isEmpty():
            return found
