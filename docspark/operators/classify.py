"""Page classification by term overlap, and the page-class output.

The score of a class on a page is the share of the class description's distinct
terms that occur on the page.  It is a documented stand-in for a hosted model;
``functions.hooks.page_classifier`` plugs in another scorer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S

# A page whose best class holds this share of its terms needs no longer prefixes.
SURE = 0.5
# Terms of a prefix that a page must share with a class before both are compared.
MATCHES = 6
PART_PAGES = 100_000

# Fixed value: what separates terms.
TERM_BREAK = r"[^\p{L}\p{N}]+"


def terms(text) -> Column:
    """Distinct lower-case terms of a text."""
    words = F.split(F.lower(F.coalesce(S._c(text), F.lit(""))), TERM_BREAK)
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def class_terms(classes: DataFrame) -> DataFrame:
    """``(class_no, name, description)`` with the distinct terms of each description."""
    return classes.select(
        F.col("class_no").cast("int").alias("class_no"),
        F.col("name").alias("page_class"),
        terms(F.coalesce(S.blank_to_null("description"), F.col("name"))).alias("terms"),
    ).where(F.size("terms") > 0)


def best_class(page_terms: Column, classes: Column, threshold: float = 0.0) -> Column:
    """Best class of one page as a struct, NULL when no score passes.

    Ties go to the class listed first.  ``classes`` may be a constant or the
    configuration of the row itself.
    """
    every = F.flatten(F.transform(classes, lambda c: c["terms"]))

    def among(known: Column) -> Column:
        scored = F.transform(
            classes,
            lambda c: F.struct(
                (F.size(F.array_intersect(c["terms"], known)) / F.size(c["terms"])).alias("score"),
                (-c["class_no"]).alias("rank"),
                c["page_class"].alias("page_class"),
                c["terms"].alias("terms"),
            ),
        )
        return S.let(F.array_max(scored), lambda b: labelled(b, known))

    def labelled(b: Column, known: Column) -> Column:
        return F.when(
            (b["score"] > 0) & (b["score"] >= threshold),
            F.struct(
                b["page_class"].alias("page_class"),
                b["score"].alias("score"),
                F.array_join(F.array_sort(F.array_intersect(b["terms"], known)), ", ").alias("reason"),
            ),
        )

    # The page's terms are cut down to those of any class once, before the
    # comparison with each class.
    return S.let(F.array_intersect(page_terms, every), among)


def known_terms(pages: DataFrame, lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(_page, known)``: the terms of each page that any class has.

    One narrow shuffle by page, which every later step shares; the text stays
    where it was read.  The key is a struct, so NULL keys meet as equal.
    """
    vocabulary = lists.select(F.explode("terms").alias("term"))
    words = S.unnest(pages, [F.struct(*keys).alias("_page")], terms("text"), "term")
    return words.join(vocabulary, "term", "left_semi").groupBy("_page").agg(F.collect_set("term").alias("known"))


def rare_first(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Classes with their terms in one global order: those of the fewest pages first."""
    pages_of = known.select(F.explode("known").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")))
    return (
        lists.select("class_no", "page_class", F.explode("terms").alias("term"))
        .join(pages_of, "term", "left")
        .groupBy("class_no", "page_class")
        .agg(ordered["term"].alias("terms"))
    )


def candidates(known: DataFrame, ranked: DataFrame, share: float) -> DataFrame:
    """``(_page, class_no)`` of every pair that can reach a share of the class's terms.

    A page with ``k`` of the ``n`` terms misses at most ``n - k`` of them, so it
    has ``m`` of the first ``n - k + m`` in any order, for each ``m`` up to ``k``.
    Only these are joined and counted; ``MATCHES`` bounds ``m``.
    """
    # The small slack keeps rounding from asking for one term too many.
    needed = F.greatest(F.ceil(F.size("terms") * F.lit(share) - F.lit(1e-6)).cast("int"), F.lit(1))
    matches = F.least(needed, F.lit(MATCHES))
    prefix = F.slice("terms", F.lit(1), F.greatest(F.size("terms") - needed + matches, F.lit(0)))
    postings = ranked.select("class_no", matches.alias("matches"), F.explode(prefix).alias("term"))
    words = known.select("_page", F.explode("known").alias("term"))
    met = words.join(postings, "term").groupBy("_page", "class_no", "matches").agg(F.count(F.lit(1)).alias("n"))
    return met.where(F.col("n") >= F.col("matches")).select("_page", "class_no")


def classify_pages(
    pages: DataFrame, classes: DataFrame, threshold: float = 0.0, keys: Sequence[str] = ("doc_id", "page_number")
) -> DataFrame:
    """Best class per page with score and reason; unmatched pages are left out.

    A containment join with prefix filter, the same for any number of classes.
    Pages that reach a share of ``SURE`` with some class have their best class
    among the few candidates of that share; the others are looked up with the
    longer prefixes of ``threshold``.  ``keys`` name a page (equal keys are one
    page, NULL included), ``class_no`` a class.  No page and no class: no rows.
    """
    lists = class_terms(classes)
    known = known_terms(pages, lists, keys)
    ranked = rare_first(lists, known)
    shared = F.array_intersect("terms", "known")

    def best(among: DataFrame, share: float) -> DataFrame:
        scored = candidates(among, ranked, share).join(known, "_page").join(ranked, "class_no").select(
            "_page",
            F.struct(
                (F.size(shared) / F.size("terms")).alias("score"),
                (-F.col("class_no")).alias("rank"),
                "page_class",
                shared.alias("shared"),
            ).alias("_b"),
        )
        return scored.groupBy("_page").agg(F.max("_b").alias("_b")).where(F.col("_b.score") >= share)

    found = best(known, max(threshold, SURE))
    if threshold < SURE:
        found = found.unionByName(best(known.join(found, "_page", "left_anti"), threshold))
    return found.select(
        *(F.col("_page")[k].alias(k) for k in keys),
        "_b.page_class",
        "_b.score",
        F.array_join(F.array_sort("_b.shared"), ", ").alias("reason"),
    )


def classify_pages_join(
    pages: DataFrame, classes: DataFrame, threshold: float = 0.0, keys: Sequence[str] = ("doc_id", "page_number")
) -> DataFrame:
    """The same by counting every match: a plain equi join on terms.

    Spark's own size check picks the join; a term that occurs everywhere is
    split by AQE.  Matches are counted before the shuffle by page.
    """
    lists = class_terms(classes).withColumn("n_terms", F.size("terms"))
    vocabulary = lists.select("class_no", "n_terms", F.explode("terms").alias("term"))
    page_terms = pages.select(*keys, F.explode(terms("text")).alias("term"))
    scores = page_terms.join(vocabulary, "term").groupBy(*keys, "class_no").agg(
        (F.count(F.lit(1)) / F.first("n_terms")).alias("score")
    )
    best = (
        scores.groupBy(*keys)
        .agg(F.max(F.struct("score", (-F.col("class_no")).alias("rank"))).alias("_b"))
        .where(F.col("_b.score") >= threshold)
        .select(*keys, F.col("_b.score").alias("score"), (-F.col("_b.rank")).alias("class_no"))
    )
    matched = F.array_join(F.array_sort(F.array_intersect("terms", terms("text"))), ", ")
    return (
        pages.select(*keys, "text")
        .join(best, list(keys))
        .join(lists.select("class_no", "page_class", "terms"), "class_no")
        .select(*keys, "page_class", "score", matched.alias("reason"))
    )


def collect_page_classes(page_labels: DataFrame, key: str = "doc_id", part_pages: int = PART_PAGES) -> DataFrame:
    """Per document and class: sorted pages and the reason of each page.

    A document of more than ``part_pages`` pages comes in numbered parts, each a
    fixed range of pages, so no list grows with the length of a document.
    """
    entries = F.array_sort(F.collect_list(F.struct("page_number", "reason")))
    part = F.expr(f"page_number div {part_pages}").alias("part_no")
    return page_labels.groupBy(key, "page_class", part).agg(
        F.array_sort(F.collect_set("page_number")).alias("page_numbers"),
        F.map_from_entries(entries).alias("classification_reasons"),
    )


def pages_in_classes(
    pages: DataFrame, page_labels: DataFrame, names: Sequence[str], keys: Sequence[str] = ("doc_id", "page_number")
) -> DataFrame:
    """Pages whose class is listed; no names keep every page."""
    if not names:
        return pages
    wanted = page_labels.where(F.col("page_class").isin(*names)).select(*keys)
    return pages.join(wanted, list(keys), "left_semi")
