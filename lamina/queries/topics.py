"""Tokens, keywords, neighbours, runs, comparison and coherence."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions.stopwords import ENGLISH
from lamina.operators import coherence, compare, neighbours, runs, tokens
from lamina.plans import analysis
from lamina.queries.sql import q
from lamina.session import cut, spread

_STOP = ", ".join(q(w) for w in ENGLISH)
_TOKENS = f"tk AS (SELECT doc_id, lang, source, [t FOR t IN regexp_extract_all(lower(coalesce(text, '')), {q(tokens.TOKEN)}) IF t NOT IN ({_STOP})] AS ts FROM documents)"
_TERMS = f"{_TOKENS}, tt AS (SELECT doc_id, lang, source, ts || [ts[i] || ' ' || ts[i + 1] FOR i IN range(1, len(ts))] AS terms FROM tk), occ AS (SELECT doc_id, lang, source, unnest(terms) AS term FROM tt)"


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def token_df(spark, sf_dir):
    return tokens.document_frequency(_docs(spark, sf_dir), pairs=False)


def ngram_df(spark, sf_dir):
    return tokens.document_frequency(_docs(spark, sf_dir)).where("df >= 5")


def ctfidf_top(spark, sf_dir):
    return tokens.ctfidf(_docs(spark, sf_dir), ["lang"], 10).withColumn("weight", F.round("weight", 9))


def _ctfidf_sql(cls: str, top: int, name: str = "top") -> str:
    return f"""
n_{name} AS (SELECT {cls} AS cls, term, count(*) AS n FROM occ GROUP BY ALL), f_{name} AS (SELECT term, sum(n) AS f FROM n_{name} GROUP BY term), c_{name} AS (SELECT cls, sum(n) AS size FROM n_{name} GROUP BY cls),
a_{name} AS (SELECT floor(avg(size)) AS a FROM c_{name}), w_{name} AS (SELECT cls, term, n / size * ln(1 + a / f) AS weight FROM n_{name} JOIN f_{name} USING (term) JOIN c_{name} USING (cls) CROSS JOIN a_{name}),
{name} AS (SELECT *, CAST(row_number() OVER (PARTITION BY cls ORDER BY round(weight, 12) DESC, term) AS INTEGER) AS rank FROM w_{name} QUALIFY rank <= {top})"""


def topic_info(spark, sf_dir):
    d = _docs(spark, sf_dir)
    words = tokens.ctfidf(d, ["lang"], 10)
    return tokens.topic_info(d.select("lang"), words, ["lang"]).select("lang", "count", "name", F.array_join("representation", ",").alias("representation"))


def representative_docs(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return tokens.representative_docs(d, "lang", tokens.ctfidf(d, ["lang"], 10, pairs=False), pairs=False)


def dictionary_ids(spark, sf_dir):
    return coherence.dictionary(_token_table(_docs(spark, sf_dir)), 2)


def document_info(spark, sf_dir):
    d = _docs(spark, sf_dir)
    info = tokens.topic_info(d.select(F.col("lang").alias("topic")), tokens.ctfidf(d, ["lang"], 10).withColumnRenamed("lang", "topic"))
    return tokens.document_info(d.select("doc_id", "source"), d.select("doc_id", F.col("lang").alias("topic")), info).select("doc_id", "source", "topic", "name", "count")


def _assigned(spark, sf_dir):
    """Run 0 by language, runs 1 to 3 by arithmetic; topic -1 stands for noise."""
    d = _docs(spark, sf_dir).select("doc_id", "lang", "text")
    base = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2).otherwise(3)
    per = F.array(*[F.struct(F.lit(r).alias("run_id"), (base if r == 0 else F.when(F.col("doc_id") % 11 == r, -1).otherwise((base + F.when(F.col("doc_id") % (r + 3) == 0, 1).otherwise(0)) % 4)).cast("int").alias("topic")) for r in range(4)])
    return d.select("doc_id", "text", F.inline(per))


_ASSIGNED = """
base AS (SELECT doc_id, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS b FROM documents),
asg AS (SELECT doc_id, r AS run_id, CASE WHEN r = 0 THEN b WHEN doc_id % 11 = r THEN -1 ELSE (b + CASE WHEN doc_id % (r + 3) = 0 THEN 1 ELSE 0 END) % 4 END AS topic FROM base, range(4) t(r)),
ref AS (SELECT doc_id, topic AS reference_topic FROM asg WHERE run_id = 0), oth AS (SELECT * FROM asg WHERE run_id <> 0 AND topic <> -1),
ov AS (SELECT run_id, reference_topic, topic, coalesce(n, 0) AS overlap FROM (SELECT DISTINCT reference_topic FROM ref) CROSS JOIN (SELECT DISTINCT run_id, topic FROM oth)
    LEFT JOIN (SELECT run_id, reference_topic, topic, count(*) AS n FROM oth JOIN ref USING (doc_id) GROUP BY ALL) USING (run_id, reference_topic, topic)),
best AS (SELECT run_id, reference_topic, topic AS best_match, overlap AS best_overlap FROM ov QUALIFY row_number() OVER (PARTITION BY run_id, reference_topic ORDER BY overlap DESC, topic) = 1)"""
_RUN_WORDS = f"""
{_TOKENS}, ro AS (SELECT run_id, topic, unnest(ts) AS term FROM tk JOIN asg USING (doc_id)), rn AS (SELECT run_id, topic, term, count(*) AS n FROM ro GROUP BY ALL), rf AS (SELECT run_id, term, sum(n) AS f FROM rn GROUP BY ALL),
rc AS (SELECT run_id, topic, sum(n) AS size FROM rn GROUP BY ALL), ra AS (SELECT run_id, floor(avg(size)) AS a FROM rc GROUP BY run_id),
rw AS (SELECT run_id, topic, term, row_number() OVER (PARTITION BY run_id, topic ORDER BY round(n / size * ln(1 + a / f), 12) DESC, term) AS rank FROM rn JOIN rf USING (run_id, term) JOIN rc USING (run_id, topic) JOIN ra USING (run_id) QUALIFY rank <= 8),
words AS (SELECT * FROM rw WHERE topic <> -1), lists AS (SELECT run_id, topic, list(term ORDER BY rank) AS ws FROM words GROUP BY ALL)"""


def topic_overlap(spark, sf_dir):
    return compare.overlaps(_assigned(spark, sf_dir).drop("text"), 0)


def best_match(spark, sf_dir):
    return compare.best_matches(topic_overlap(spark, sf_dir))


def _run_words(spark, sf_dir, a):
    return tokens.ctfidf_runs(_docs(spark, sf_dir), a, 8, pairs=False).where("topic <> -1")


def topics_compare(spark, sf_dir):
    a = _assigned(spark, sf_dir).drop("text")
    return compare.compare_topics(a, _run_words(spark, sf_dir, a), 0).withColumns({c: F.round(c, 6) for c in ("preservation", "word_jaccard")})


def word_stability(spark, sf_dir):
    a = _assigned(spark, sf_dir).drop("text")
    w = _run_words(spark, sf_dir, a)
    return compare.stable_words(compare.compare_topics(a, w, 0), w, 0).withColumn("seed_proportion", F.round("seed_proportion", 6))


def run_summary(spark, sf_dir):
    a = _assigned(spark, sf_dir).select("run_id", "doc_id", "topic")
    table = runs.grid(spark, (12,), (10,), (1, 2, 3, 4))
    return runs.summary(table, a).select("run_id", "seed", "n_documents", "n_topics", "n_outliers")


def topic_members(spark, sf_dir):
    a = _assigned(spark, sf_dir).select("run_id", "doc_id", "topic")
    return runs.members(a, "doc_id").select("run_id", "topic", "doc_count", F.sha2(F.array_join(F.transform("doc_indices", lambda x: x.cast("string")), ","), 256).alias("members_sha"))


def relabelled(spark, sf_dir):
    a = _assigned(spark, sf_dir).select("run_id", "doc_id", F.when(F.col("topic") >= 0, 9 - F.col("topic")).otherwise(-1).alias("topic"))
    return tokens.relabel_by_size(a, ["run_id"])


def knn_cosine(spark, sf_dir):
    return neighbours.knn(_vectors(spark, sf_dir), 5).select("vec_id", "neighbour", "rank", F.round("sim", 6).alias("sim"))


_SIMS = "s AS (SELECT a.vec_id, b.vec_id AS neighbour, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, neighbour) AS INTEGER) AS rank FROM s QUALIFY rank <= 5)"


def core_distance(spark, sf_dir):
    return neighbours.core_distances(neighbours.knn(_vectors(spark, sf_dir), 2), 2).withColumn("core", F.round("core", 6))


def mutual_reachability(spark, sf_dir):
    near = cut(neighbours.knn(_vectors(spark, sf_dir), 5))  # read three times
    return neighbours.mutual_reachability(near, neighbours.core_distances(near, 2)).withColumn("mreach", F.round("mreach", 6))


def density_clusters(spark, sf_dir):
    return runs.fit(_vectors(spark, sf_dir), runs.grid(spark, (12,), (10,), (42,)))


def seed_runs(spark, sf_dir):
    table = runs.grid(spark, (12,), (10,), runs.SEEDS)
    return runs.summary(table, runs.fit(_vectors(spark, sf_dir), table))


def param_grid(spark, sf_dir):
    return runs.grid(spark, (5, 10, 15, 20, 25), (5, 10, 15, 20))


def _dictionary(d, least):
    return tokens.document_frequency(d, pairs=False).where(F.col("df") >= least)


def _token_table(d):
    return spread(d.select("doc_id", "text")).select("doc_id", tokens.tokens(F.col("text")).alias("tokens"))


def valid_tokens(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return coherence.valid_tokens(_token_table(d), _dictionary(d, 20)).select("doc_id", F.size("tokens").alias("n"), F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha"))


def _lang_words(d):
    base = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2).otherwise(3)
    return tokens.ctfidf(d.select("doc_id", "text", F.lit(0).alias("run_id"), base.alias("topic")), ["run_id", "topic"], 6, pairs=False)


def _counts(spark, sf_dir):
    d = _docs(spark, sf_dir)
    words = _lang_words(d)
    listed = [r[0] for r in words.select("term").distinct().collect()]  # six words a topic
    return words, coherence.window_counts(_token_table(d), listed)


def window_counts(spark, sf_dir):
    return _counts(spark, sf_dir)[1]


def npmi_pairs(spark, sf_dir):
    return coherence.npmi(_counts(spark, sf_dir)[1]).withColumn("npmi", F.round("npmi", 6))


def coherence_cv(spark, sf_dir):
    words, counts = _counts(spark, sf_dir)
    return coherence.coherence(words, counts).withColumn("coherence_cv", F.round("coherence_cv", 6))


_LANG_WORDS = f"""
{_TOKENS}, occ AS (SELECT CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS topic, unnest(ts) AS term FROM tk), {_ctfidf_sql('topic', 6)},
pos AS (SELECT doc_id, unnest(ts) AS term, generate_subscripts(ts, 1) - 1 AS p, greatest(1, len(ts) - 109) AS nw FROM tk), hit AS (SELECT * FROM pos WHERE term IN (SELECT term FROM top)),
win AS (SELECT DISTINCT doc_id, term, unnest(range(greatest(0, p - 109), least(nw, p + 1))) AS i FROM hit),
one AS (SELECT term, count(*) AS n FROM win GROUP BY term), two AS (SELECT x.term AS a, y.term AS b, count(*) AS n FROM win x JOIN win y ON x.doc_id = y.doc_id AND x.i = y.i AND x.term < y.term GROUP BY ALL),
total AS (SELECT sum(greatest(1, len(ts) - 109)) AS t FROM tk)"""
_NPMI = f"{_LANG_WORDS}, np AS (SELECT a, b, ln((two.n / t + 1e-12) / ((x.n / t) * (y.n / t))) / -ln(two.n / t + 1e-12) AS npmi FROM two JOIN one x ON x.term = a JOIN one y ON y.term = b CROSS JOIN total)"


def topic_search(spark, sf_dir):
    """Grid search over vectors that stand for the first documents' texts."""
    d = _docs(spark, sf_dir).select("doc_id", "text").join(_vectors(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
    return analysis.search(d, (8, 16), (5, 10))


def seed_stability(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", "text").join(_vectors(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
    return analysis.stability(d, (42, 7, 13))["topic_comparisons"]


def word_jaccard(spark, sf_dir):
    d = _docs(spark, sf_dir)
    ws = tokens.ctfidf(d, ["lang"], 20, pairs=False).groupBy("lang").agg(F.collect_set("term").alias("ws"))
    a, b = ws.select(F.col("lang").alias("a"), F.col("ws").alias("x")), ws.select(F.col("lang").alias("b"), F.col("ws").alias("y"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", F.round(compare.jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))


QUERIES = {
    f.__name__: f
    for f in (
        token_df, ngram_df, ctfidf_top, topic_info, representative_docs, dictionary_ids, document_info, topic_overlap, best_match, topics_compare, word_stability, word_jaccard, run_summary, topic_members, relabelled, knn_cosine, core_distance, mutual_reachability,
        density_clusters, seed_runs, param_grid, valid_tokens, window_counts, npmi_pairs, coherence_cv, topic_search, seed_stability,
    )
}
ORACLES = {
    "token_df": f"WITH {_TOKENS}, o AS (SELECT doc_id, unnest(ts) AS term FROM tk) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM o GROUP BY term",
    "ngram_df": f"WITH {_TERMS} SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM occ GROUP BY term HAVING count(DISTINCT doc_id) >= 5",
    "ctfidf_top": f"WITH {_TERMS}, {_ctfidf_sql('lang', 10)} SELECT cls AS lang, term, round(weight, 9) AS weight, rank FROM top",
    "topic_info": f"WITH {_TERMS}, {_ctfidf_sql('lang', 10)}, l AS (SELECT cls, list(term ORDER BY rank) AS r FROM top GROUP BY cls), c AS (SELECT lang, count(*) AS count FROM documents GROUP BY lang) SELECT lang, count, lang || '_' || array_to_string(r[1:4], '_') AS name, array_to_string(r, ',') AS representation FROM c JOIN l ON cls = lang",
    "document_info": f"WITH {_TERMS}, {_ctfidf_sql('lang', 10)}, l AS (SELECT cls, list(term ORDER BY rank) AS r FROM top GROUP BY cls) SELECT doc_id, source, lang AS topic, lang || '_' || array_to_string(r[1:4], '_') AS name, count(*) OVER (PARTITION BY lang) AS count FROM documents JOIN l ON cls = lang",
    "representative_docs": f"""WITH {_TOKENS}, occ AS (SELECT doc_id, lang, unnest(ts) AS term FROM tk), {_ctfidf_sql('lang', 10)}, n AS (SELECT doc_id, lang, term, count(*) AS n FROM occ GROUP BY ALL),
s AS (SELECT lang, doc_id, sum(coalesce(n * weight, 0)) / sqrt(sum(n * n)) AS s FROM n LEFT JOIN top ON cls = lang AND top.term = n.term GROUP BY ALL)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY round(s, 9) DESC, doc_id) AS INTEGER) AS place, doc_id FROM s QUALIFY place <= 3""",
    "dictionary_ids": f"WITH {_TOKENS}, o AS (SELECT doc_id, unnest(ts) AS term FROM tk), d AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM o GROUP BY term HAVING count(DISTINCT doc_id) >= 2) SELECT row_number() OVER (ORDER BY term) - 1 AS id, term, df, tf FROM d",
    "topic_overlap": f"WITH {_ASSIGNED} SELECT * FROM ov",
    "best_match": f"WITH {_ASSIGNED} SELECT * FROM best",
    "topics_compare": f"""WITH {_ASSIGNED}, {_RUN_WORDS}, sz AS (SELECT reference_topic, count(*) AS n FROM ref GROUP BY 1)
SELECT best.run_id AS comparison_run, reference_topic, best_match, best_overlap, round(best_overlap / n, 6) AS preservation, round(len(list_intersect(x.ws, y.ws)) / len(list_distinct(x.ws || y.ws)), 6) AS word_jaccard
FROM best JOIN sz USING (reference_topic) JOIN lists x ON x.run_id = 0 AND x.topic = reference_topic JOIN lists y ON y.run_id = best.run_id AND y.topic = best_match""",
    "word_stability": f"""WITH {_ASSIGNED}, {_RUN_WORDS}, al AS (SELECT topic AS reference_topic, run_id, -1 AS r, rank, term FROM words WHERE run_id = 0
    UNION ALL SELECT reference_topic, best.run_id, best.run_id, rank, term FROM best JOIN words ON words.run_id = best.run_id AND topic = best_match),
g AS (SELECT reference_topic, term AS word, count(DISTINCT run_id) AS seed_count, min(r * 1000 + rank) AS f FROM al GROUP BY ALL)
SELECT reference_topic, word, seed_count, round(seed_count / 4, 6) AS seed_proportion, CAST(row_number() OVER (PARTITION BY reference_topic ORDER BY seed_count DESC, f, word) AS INTEGER) AS position FROM g""",
    "word_jaccard": f"WITH {_TOKENS}, occ AS (SELECT lang, unnest(ts) AS term FROM tk), {_ctfidf_sql('lang', 20)}, l AS (SELECT cls, list(term) AS ws FROM top GROUP BY cls) SELECT x.cls AS a, y.cls AS b, round(len(list_intersect(x.ws, y.ws)) / len(list_distinct(x.ws || y.ws)), 6) AS jaccard FROM l x JOIN l y ON x.cls < y.cls",
    "run_summary": f"WITH {_ASSIGNED} SELECT CAST(run_id AS INTEGER) AS run_id, CAST(run_id + 1 AS INTEGER) AS seed, count(*) AS n_documents, count(DISTINCT topic) FILTER (topic <> -1) AS n_topics, count(*) FILTER (topic = -1) AS n_outliers FROM asg GROUP BY run_id",
    "topic_members": f"WITH {_ASSIGNED} SELECT CAST(run_id AS INTEGER) AS run_id, topic, count(*) AS doc_count, sha256(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS members_sha FROM asg GROUP BY run_id, topic",
    "relabelled": f"WITH {_ASSIGNED}, z AS (SELECT run_id, topic, count(*) AS n, min(doc_id) AS m FROM asg WHERE topic <> -1 GROUP BY ALL), nw AS (SELECT run_id, topic, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, m) - 1 AS k FROM z) SELECT asg.run_id, doc_id, coalesce(k, -1) AS topic FROM asg LEFT JOIN nw USING (run_id, topic)",
    "knn_cosine": f"WITH {_SIMS} SELECT vec_id, neighbour, rank, round(sim, 6) AS sim FROM k",
    "core_distance": f"WITH {_SIMS} SELECT vec_id, round(1 - sim, 6) AS core FROM k WHERE rank = 2",
    "mutual_reachability": f"WITH {_SIMS}, c AS (SELECT vec_id, 1 - sim AS core FROM k WHERE rank = 2) SELECT k.vec_id, neighbour, rank, round(greatest(a.core, b.core, 1 - sim), 6) AS mreach FROM k JOIN c a ON a.vec_id = k.vec_id JOIN c b ON b.vec_id = neighbour",
    "param_grid": "SELECT CAST(i * 4 + j AS INTEGER) AS run_id, 42 AS seed, [5, 10, 15, 20, 25][i + 1] AS min_cluster_size, [5, 10, 15, 20][j + 1] AS n_neighbors, 5 AS n_components FROM range(5) a(i), range(4) b(j)",
    "valid_tokens": f"WITH {_TOKENS}, p AS (SELECT doc_id, unnest(ts) AS term, generate_subscripts(ts, 1) AS i FROM tk), v AS (SELECT term FROM p GROUP BY term HAVING count(DISTINCT doc_id) >= 20) SELECT doc_id, CAST(count(*) AS INTEGER) AS n, sha256(string_agg(term, ' ' ORDER BY i)) AS tokens_sha FROM p JOIN v USING (term) GROUP BY doc_id",
    "window_counts": f"WITH {_LANG_WORDS} SELECT '' AS a, '' AS b, CAST(t AS BIGINT) AS n FROM total UNION ALL SELECT term, term, n FROM one UNION ALL SELECT a, b, n FROM two",
    "npmi_pairs": f"WITH {_NPMI} SELECT a, b, round(npmi, 6) AS npmi FROM np",
    "coherence_cv": f"""WITH {_NPMI}, ww AS (SELECT cls AS topic, term FROM top), pr AS (SELECT x.topic, x.term AS a, y.term AS b FROM ww x JOIN ww y USING (topic)),
v AS (SELECT topic, pr.a, pr.b, coalesce(CASE WHEN pr.a = pr.b THEN ln((o.n / t + 1e-12) / ((o.n / t) * (o.n / t))) / -ln(o.n / t + 1e-12) ELSE np.npmi END, ln(1e-12 / ((o.n / t) * (o2.n / t))) / -ln(1e-12)) AS v
    FROM pr CROSS JOIN total JOIN one o ON o.term = pr.a JOIN one o2 ON o2.term = pr.b LEFT JOIN np ON np.a = least(pr.a, pr.b) AND np.b = greatest(pr.a, pr.b)),
s AS (SELECT topic, b, sum(v) AS s FROM v GROUP BY ALL), c AS (SELECT topic, a, sum(v * s) / (sqrt(sum(v * v)) * sqrt(sum(s * s))) AS c FROM v JOIN s USING (topic, b) GROUP BY ALL), g AS (SELECT topic, avg(c) AS c FROM c GROUP BY topic)
SELECT 0 AS run_id, round(avg(c), 6) AS coherence_cv FROM g""",
}
