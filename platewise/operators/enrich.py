"""Menu enrichment: ingredient text to base names, roles and a cuisine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from platewise.functions.answers import with_answer_roles
from platewise.functions.scalars import not_blank, or_default
from platewise.operators.dedup import top_per_key
from platewise.operators.joins import lookup_join
from platewise.session import materialize

# Food groups of the lexicon that fill each role.
ROLE_GROUPS = {"genres": ("protein",), "genre_l2": ("grain", "starch"), "genre_l3": ("vegetable", "fruit", "spice")}
# End of the fixed values.
MENU_KEYS = ["item_id", "meal", "creation_ts"]


def phrase_words(text) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def longest_phrases(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """term, base, food_group of the lexicon phrase in each term: the leftmost one, of those the longest.

    Only the distinct terms are looked up, by an equality join of their word runs of up to the lexicon's longest
    phrase. Terms without a phrase are left out. Of equal phrases the lowest base counts.
    """
    known = lexicon.select(F.array_join(phrase_words(F.col("term")), " ").alias("phrase"), F.struct("base", "food_group").alias("entry"))
    known = materialize(known.where("phrase <> ''").groupBy("phrase").agg(F.min("entry").alias("entry")), "phrases")
    most = known.agg(F.max(F.size(F.split("phrase", " ")))).first()[0] or 0
    words = terms.select("term").distinct().withColumn("words", phrase_words(F.col("term"))).where(F.size("words") > 0)
    runs = words.select("term", "words", F.posexplode("words").alias("start", "word"), F.lit(most).alias("most")).select(
        "term", "start", F.explode(F.sequence(F.lit(1), F.least("most", F.size("words") - F.col("start")))).alias("size"), "words").select(
        "term", "start", "size", F.array_join(F.slice("words", F.col("start") + 1, F.col("size")), " ").alias("phrase")) if most else (
        words.select("term", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit("").alias("phrase")).limit(0))
    found = lookup_join(runs, known, "phrase", stored=True)
    best = found.groupBy("term").agg(F.min(F.struct("start", (-F.col("size")).alias("size"), "entry")).alias("best"))
    return best.select("term", "best.entry.base", "best.entry.food_group")


def ingredient_terms(menus: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One row per ingredient of a menu: its place, base name and food group.

    The base is that of the longest lexicon phrase in the ingredient ("brown rice" has "rice"). An ingredient without
    one keeps its own name and belongs to the group 'other'.
    """
    terms = (menus.select(*MENU_KEYS, F.posexplode_outer(F.split("ingredients", ",")).alias("pos", "term"))
             .withColumn("term", F.lower(F.trim("term"))))
    return (lookup_join(terms, longest_phrases(terms, lexicon), "term", "left")
            .withColumn("base", F.when(not_blank("term"), F.coalesce("base", "term")))
            .withColumn("food_group", F.coalesce("food_group", F.lit("other"))))


def cuisine_per_menu(terms: DataFrame, cuisines: DataFrame) -> DataFrame:
    """The cuisine that most ingredients of a menu point to; the first name wins a tie."""
    votes = (lookup_join(terms.where(F.col("base").isNotNull()).select("item_id", "base"), cuisines, "base", stored=True)
             .groupBy("item_id", "cuisine").agg(F.count(F.lit(1)).alias("votes")))
    return top_per_key(votes, ["item_id"], [F.desc("votes"), "cuisine"], 1).select("item_id", "cuisine")


def enrich_menus(menus: DataFrame, lexicon: DataFrame, cuisines: DataFrame) -> DataFrame:
    """Menus in table spelling: the first ingredient of a role's food groups fills it, the rest are listed.

    A group of this aggregation is the ingredient text of one menu, so it is never larger than a row.
    """
    terms = ingredient_terms(menus, lexicon)
    first = [F.min(F.when(F.col("food_group").isin(*groups), F.struct("pos", "base"))).alias(f"_{role}")
             for role, groups in ROLE_GROUPS.items()]
    listed = F.collect_list(F.when(F.col("base").isNotNull(), F.struct("pos", "base"))).alias("_all")
    grouped = terms.groupBy(*MENU_KEYS).agg(*first, listed)
    taken = F.array(*[F.coalesce(F.col(f"_{role}.pos"), F.lit(-1)) for role in ROLE_GROUPS])
    rest = F.filter(F.array_sort("_all"), lambda x: ~F.array_contains(taken, x["pos"]))
    roles = [F.coalesce(F.col(f"_{role}.base"), F.lit("")).alias(role) for role in ROLE_GROUPS]
    shaped = grouped.select("item_id", F.col("creation_ts").alias("created_at"), F.col("meal").alias("name"),
                            *roles, F.transform(rest, lambda x: x["base"]).alias("product_description"))
    return (lookup_join(shaped, cuisine_per_menu(terms, cuisines), "item_id", "left")
            .withColumn("content_classification", or_default("cuisine", "none")).drop("cuisine"))


def enrich_with_model(menus: DataFrame, answer: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Enrich through a caller's text model: batches of (meal, ingredients) in, JSON answers out.

    Spark decides how many batches run at once. A batch that the model fails on is asked again menu by menu;
    menus that it fails on alone are left out, so that a later load finds them new and asks again.
    """
    source = menus.select("item_id", F.col("creation_ts").alias("created_at"), F.col("meal").alias("name"),
                          "ingredients")
    schema = T.StructType([*source.schema.fields, T.StructField("answer", T.StringType())])

    def asked(batch: pd.DataFrame) -> pd.DataFrame | None:
        try:
            return batch.assign(answer=list(answer(batch)))
        except Exception:  # a model failure must not stop the other menus
            return None

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = asked(batch)
            if done is not None:
                yield done
                continue
            for i in range(len(batch)):
                done = asked(batch.iloc[i:i + 1])
                if done is not None:
                    yield done

    return with_answer_roles(source.mapInPandas(ask, schema), "answer").drop("answer", "ingredients")
