"""Tokens, n-grams and class-weighted keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.stopwords import ENGLISH
from lamina.functions.text import WORDCHAR
from lamina.session import by_key, cut, spread

TOKEN = f"[{WORDCHAR}]{{2,}}"


def tokens(text: Column, stop: list[str] | tuple = ENGLISH) -> Column:
    """Lower-cased runs of two word characters or more, stop words out."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def bigrams(ts: Column) -> Column:
    """Neighbours after stop words are gone, so pairs bridge them."""
    return F.filter(F.zip_with(ts, F.slice(ts, 2, F.greatest(F.size(ts), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)), lambda g: g.isNotNull())


def terms(text: Column, stop=ENGLISH, pairs: bool = True) -> Column:
    """Unigrams, then bigrams."""
    ts = tokens(text, stop)
    return F.concat(ts, bigrams(ts)) if pairs else ts


def exploded(docs: DataFrame, keys: list[str], text: str = "text", stop=ENGLISH, pairs: bool = True, placed: bool = False) -> DataFrame:
    """(keys, term), a row per occurrence.  ``placed``: docs come from a shuffle,
    which looking at their parts would run once more."""
    docs = docs.select(*keys, text)
    docs = docs if placed else spread(docs)
    if not pairs:  # stop words go after the explosion, where the test is compiled code
        found = docs.select(*keys, F.explode(tokens(F.col(text), ())).alias("term"))
        return found.where(~F.col("term").isin(*stop)) if stop else found
    # the array is made once, in a projection of its own
    made = docs.select(*keys, tokens(F.col(text), stop).alias("__t"))
    return made.select(*keys, F.explode(F.concat("__t", bigrams(F.col("__t")))).alias("term"))


def counted(docs: DataFrame, keys: list[str], doc: str, **kw) -> DataFrame:
    """(keys, term, n) with ``doc`` among the keys.  Texts are put by document
    first, so occurrences are counted where they arise and never shuffled."""
    return exploded(by_key(docs, doc), keys, placed=True, **kw).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(docs: DataFrame, doc: str = "doc_id", **kw) -> DataFrame:
    text = kw.get("text", "text")
    return counted(docs.select(doc, text), [doc], doc, **kw).groupBy("term").agg(F.count(doc).alias("df"), F.sum("n").alias("tf"))


def ctfidf(docs: DataFrame, classes: list[str], top: int = 10, min_classes: int = 1, **kw) -> DataFrame:
    """(classes, rank, term, weight): best terms of each class.

    Weight: share of the class's terms times ln(1 + A / f), A the mean number
    of terms per class (whole part) and f the term's count in all classes.  The
    last entry of ``classes`` names the class, those before it separate runs.
    ``min_classes`` leaves out terms that fewer classes of the run have.
    Ties: greater weight first, then the term.
    """
    return best_terms(exploded(docs, classes, **kw).groupBy(*classes, "term").agg(F.count(F.lit(1)).alias("n")), classes, top, min_classes)


def ctfidf_runs(docs: DataFrame, assignments: DataFrame, top: int = 10, min_classes: int = 1, doc: str = "doc_id", **kw) -> DataFrame:
    """(run_id, topic, rank, term, weight): ``ctfidf`` of many runs over one corpus.

    Texts are tokenised once, whatever the number of runs: occurrences are
    counted by the combination of topics that their document has over all
    runs, and only those counts are dealt out to runs.
    """
    has = assignments.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("run_id", "topic"))).alias("__t"))  # a few runs
    kind = dict(assignments.dtypes)
    # a short text serves as the key of a combination; as an array it would outweigh the terms
    code = F.array_join(F.transform("__t", lambda x: F.concat(F.coalesce(x["run_id"].cast("string"), F.lit("")), F.lit(":"), F.coalesce(x["topic"].cast("string"), F.lit("")))), ",")
    met = exploded(docs.join(has.select(doc, code.alias("__c")), doc), ["__c"], placed=True, **kw).groupBy("__c", "term").agg(F.count(F.lit(1)).alias("n"))
    part = lambda x, i, name: F.nullif(F.split(x, ":")[i], F.lit("")).cast(kind[name]).alias(name)
    dealt = F.transform(F.split("__c", ","), lambda x: F.struct(part(x, 0, "run_id"), part(x, 1, "topic")))
    counts = met.select(F.inline(dealt), "term", "n").groupBy("run_id", "topic", "term").agg(F.sum("n").alias("n"))
    return best_terms(counts, ["run_id", "topic"], top, min_classes)


def best_terms(counts: DataFrame, classes: list[str], top: int, min_classes: int = 1) -> DataFrame:
    """``ctfidf`` from (classes, term, n).

    Sizes of classes go to every task, a row for each class: as a shuffled
    join they would bring all terms of a class to one task."""
    run = classes[:-1]
    term = Window.partitionBy(*run, "term")
    met = counts.select("*", F.sum("n").over(term).alias("f"), F.count(F.lit(1)).over(term).alias("__k"))
    counts = cut(met.where(F.col("__k") >= min_classes).drop("__k"))  # two branches read it
    per_class = counts.groupBy(*classes).agg(F.sum("n").alias("size"))
    per_class = per_class.withColumn("mean_size", F.floor(F.avg("size").over(Window.partitionBy(*(run or [F.lit(0)])))))
    both = counts.join(F.broadcast(per_class), classes)
    weight = F.col("n") / F.col("size") * F.log1p(F.col("mean_size") / F.col("f"))
    w = Window.partitionBy(*classes).orderBy(F.round("weight", 12).desc(), "term")
    found = both.select(*classes, "term", weight.alias("weight")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return cut(found)  # a few terms a class, which may be read often


def topic_info(assignments: DataFrame, words: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(topic, count, name, representation) with name topic_w1_w2_w3_w4."""
    keys = keys or ["topic"]
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"])
    listed = words.groupBy(*keys).agg(ranked.alias("representation"))
    counts = assignments.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    named = counts.join(listed, keys, "left").withColumn("representation", F.coalesce("representation", F.array().cast("array<string>")))
    return named.withColumn("name", F.concat_ws("_", F.col(keys[-1]).cast("string"), F.slice("representation", 1, 4)))


def representative_docs(docs: DataFrame, topic: str, words: DataFrame, top: int = 3, doc: str = "doc_id", **kw) -> DataFrame:
    """(topic, place, doc): the documents of each topic most like its keywords.

    Likeness is the inner product of a document's term counts, scaled to length
    one, with the keywords' weights (``words``: topic, term, weight); ties by
    document."""
    counts = counted(docs, [doc, topic], doc, **kw)
    length = F.sqrt(F.sum(F.col("n") * F.col("n")))
    scored = counts.join(F.broadcast(words.select(topic, "term", "weight")), [topic, "term"], "left").groupBy(topic, doc).agg((F.sum(F.coalesce(F.col("n") * F.col("weight"), F.lit(0.0))) / length).alias("like"))
    w = Window.partitionBy(topic).orderBy(F.round("like", 9).desc(), doc)
    return scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(topic, "place", doc)


def document_info(corpus: DataFrame, assignments: DataFrame, info: DataFrame, doc: str = "doc_id") -> DataFrame:
    return corpus.join(assignments, doc).join(info, "topic", "left")


def relabel_by_size(assignments: DataFrame, keys: list[str], doc: str = "doc_id") -> DataFrame:
    """Topics renumbered from 0 by falling size, ties by least member; -1 stays."""
    sizes = assignments.where("topic <> -1").groupBy(*keys, "topic").agg(F.count(F.lit(1)).alias("__n"), F.min(doc).alias("__m"))
    w = Window.partitionBy(*keys).orderBy(F.col("__n").desc(), "__m") if keys else Window.orderBy(F.col("__n").desc(), "__m")
    new = sizes.select(*keys, "topic", (F.row_number().over(w) - 1).cast("int").alias("__new"))
    return assignments.join(new, [*keys, "topic"], "left").withColumn("topic", F.coalesce("__new", F.lit(-1))).drop("__new")
