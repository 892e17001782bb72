"""Topics of clusters and cluster search. The ready clustering of documents is their source."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import cluster, corpus, features, fold_in, meaning, search, topics
from docloom.plans import sql
from docloom.plans.feature_queries import MIN_DF, TERMS, stored_tokens, vectors, vocabulary
from docloom.plans.pipeline import describe_clusters, search_meaning, search_text
from docloom.plans.registry import query, table
from docloom.plans.text_queries import documents, tokens
from docloom.runtime import broadcast_bounded, materialize

TAGS = 10
QUERY_TEXT = "nation"


def clusters(spark, folder):
    """(doc_id, cluster_id) from the source column."""
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.substring("source", 4, 10).cast("int").alias("cluster_id"))


def model(spark, folder, language=None):
    """Topic model of all documents, or of one language."""
    rows = tokens(spark, folder)
    if language:
        rows = corpus.filter_language(rows, language, "lang")
    return describe_clusters(rows, clusters(spark, folder), TAGS, TERMS, MIN_DF)


_TOPICS = f"WITH {sql.TOKENS}, {sql.vocab()}, {sql.TOPICS}"


@query("attach_clusters", f"WITH {sql.TOKENS} SELECT doc_id, cluster_id, CAST(len(t) AS INTEGER) AS n FROM tokens")
def attach_clusters(spark, folder):
    rows = tokens(spark, folder).select("doc_id", "tokens")
    return topics.attach_clusters(rows, clusters(spark, folder)).select("doc_id", "cluster_id", F.size("tokens").alias("n"))


@query("cluster_topics", f"{_TOPICS} SELECT cluster_id, term, round(weight, 9) AS weight FROM topics")
def cluster_topics(spark, folder):
    return model(spark, folder).topics.select("cluster_id", "term", F.round("weight", 9).alias("weight"))


@query("top_terms", f"{_TOPICS} SELECT cluster_id, term, rank, round(weight, 9) AS weight FROM ranked WHERE rank <= {TAGS}")
def top_terms(spark, folder):
    return model(spark, folder).top.withColumn("weight", F.round("weight", 9))


@query("taggings", f"""{_TOPICS}
  SELECT cluster_id, string_agg(term, ', ' ORDER BY rank) AS tags,
         string_agg(printf('%1.4f', weight), ' ' ORDER BY rank) AS weights
  FROM ranked WHERE rank <= {TAGS} GROUP BY cluster_id""")
def taggings(spark, folder):
    tagged = model(spark, folder).taggings
    return tagged.select(
        "cluster_id",
        F.array_join("tags", ", ").alias("tags"),
        F.array_join(F.transform("weights", lambda w: F.format_string("%1.4f", w)), " ").alias("weights"),
    )


@query("tag_table", f"{_TOPICS} SELECT term AS tag, cluster_id, cluster_id AS line, rank - 1 AS position FROM ranked WHERE rank <= {TAGS}")
def tag_table(spark, folder):
    return topics.tag_table(model(spark, folder).taggings)


@query("decode_terms", f"""WITH {sql.TOKENS}, {sql.vocab()}
  SELECT doc_id, term, p.tf FROM postings p JOIN weights USING (term)""")
def decode_terms(spark, folder):
    rows = stored_tokens(spark, folder)
    vocab = vocabulary(rows)
    coded = features.count_vectorize(rows, vocab, TERMS).select("doc_id", "term_id", "tf")
    return topics.decode_terms(coded, vocab, TERMS)


@query("clustered_documents", f"""{_TOPICS},
  tagged AS (SELECT cluster_id, string_agg(term, ', ' ORDER BY rank) AS tags FROM ranked WHERE rank <= {TAGS} GROUP BY cluster_id)
  SELECT d.doc_id, CAST(substr(source, 4) AS INTEGER) AS cluster_id, n_chars, tags
  FROM documents d LEFT JOIN tagged ON tagged.cluster_id = CAST(substr(source, 4) AS INTEGER)""")
def clustered_documents(spark, folder):
    docs = documents(spark, folder).select("doc_id", "n_chars")
    tagged = model(spark, folder).taggings.select("cluster_id", F.array_join("tags", ", ").alias("tags"))
    return topics.clustered_documents(docs, clusters(spark, folder), tagged)


@query("relevant_documents", f"""{_TOPICS},
  scored AS (SELECT doc_id, k.cluster_id, sum(p.tf * idf * t.weight) AS weight
             FROM postings p JOIN tokens k USING (doc_id) JOIN weights USING (term)
             JOIN topics t ON t.term = p.term AND t.cluster_id = k.cluster_id GROUP BY ALL),
  placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY round(weight, 9) DESC, doc_id) AS INTEGER) AS rank
             FROM scored)
  SELECT doc_id, cluster_id, rank, round(weight, 6) AS weight FROM placed WHERE rank <= 5""")
def relevant_documents(spark, folder):
    m = model(spark, folder)
    # the clusters are counted, so that the topic table is broadcast only when it is small
    weights = topics.document_weights(m.tokens, m.topics, m.vocab, m.documents, TERMS, m.taggings.count())
    return topics.relevant_documents(weights, 5).withColumn("weight", F.round("weight", 6))


_LINES = r"""
  lines AS (SELECT doc_id AS line, rtrim((CASE WHEN lang = 'fr' THEN 'x' ELSE '' END) || CAST(doc_id % 7 AS VARCHAR) || ' '
                   || replace(replace(text, chr(10), ' '), '. ', ', ') || '  ', ' ') AS value FROM documents),
  heads AS (SELECT line, value, regexp_extract(value, '^([+-]?[0-9]+)( |, |$)', 1) AS head FROM lines),
  tags AS (SELECT line, CAST(head AS INTEGER) AS cluster_id,
                  unnest(string_split(regexp_replace(value, '^[+-]?[0-9]+ ?', ''), ', ')) AS tag,
                  generate_subscripts(string_split(regexp_replace(value, '^[+-]?[0-9]+ ?', ''), ', '), 1) - 1 AS position
           FROM heads WHERE head <> '')"""


def tag_lines(spark, folder):
    """Documents as tag-file lines; French ones get a head that is not an integer."""
    head = F.concat(F.when(F.col("lang") == "fr", "x").otherwise(""), (F.col("doc_id") % 7).cast("string"))
    body = F.replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(". "), F.lit(", "))
    return documents(spark, folder).select(
        F.col("doc_id").alias("line"), F.concat(head, F.lit(" "), body, F.lit("  ")).alias("value")
    )


@query("parse_taggings", f"""WITH {_LINES}
  SELECT tag, cluster_id, line, CAST(position AS INTEGER) AS position FROM tags WHERE tag <> ''""")
def parse_taggings(spark, folder):
    return search.parse_taggings(tag_lines(spark, folder))


@query("dedupe_tags", f"""WITH {_LINES}
  SELECT tag, cluster_id FROM tags WHERE tag <> ''
  QUALIFY row_number() OVER (PARTITION BY tag ORDER BY line DESC, position DESC) = 1""")
def dedupe_tags(spark, folder):
    return search.dedupe_tags(search.parse_taggings(tag_lines(spark, folder)))


def vector_tags(spark, folder):
    """Every embedding as a tag of its label."""
    v = vectors(spark, folder)
    return v.select(F.concat(F.lit("tag_"), F.col("doc_id").cast("string")).alias("tag"), "cluster_id", "vec")


@query("search", """
  WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings),
  q AS (SELECT vec AS qvec FROM v ORDER BY vec_id LIMIT 1),
  s AS (SELECT label, list_cosine_similarity(vec, qvec) AS score FROM v CROSS JOIN q),
  top AS (SELECT * FROM s QUALIFY rank() OVER (ORDER BY score DESC) <= 25)
  SELECT label AS cluster_id, round(greatest(max(score), 0.0), 9) AS score FROM top GROUP BY label""")
def search_one(spark, folder):
    v = vectors(spark, folder)
    asked = v.orderBy("doc_id").select("vec").first()["vec"]
    return search.search(F.lit(asked), vector_tags(spark, folder), 25)


@query("search_batch", """
  WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings),
  s AS (SELECT q.vec_id AS query_id, t.label, list_cosine_similarity(t.vec, q.vec) AS score FROM v q CROSS JOIN v t),
  top AS (SELECT * FROM s QUALIFY rank() OVER (PARTITION BY query_id ORDER BY score DESC) <= 5)
  SELECT query_id, label AS cluster_id, round(greatest(max(score), 0.0), 9) AS score FROM top GROUP BY query_id, label""")
def search_batch(spark, folder):
    queries = vectors(spark, folder).select(F.col("doc_id").alias("query_id"), "vec")
    return search.search_batch(queries, vector_tags(spark, folder), 5)


def _english(check: str) -> str:
    """Topics of English documents only."""
    only = sql.TOKENS.replace("FROM documents)", "FROM documents WHERE lang = 'en')")
    return f"WITH {only}, {sql.vocab()}, {sql.TOPICS}, {check}"


@query("search_text", _english(f"""
  tagged AS (SELECT term AS tag, cluster_id FROM ranked WHERE rank <= {TAGS}
             QUALIFY row_number() OVER (PARTITION BY term ORDER BY cluster_id DESC, rank DESC) = 1),
  embedded AS (SELECT cluster_id, {sql.embed('tag')} AS vec FROM tagged),
  asked AS (SELECT {sql.embed(sql.quoted(QUERY_TEXT))} AS qvec),
  s AS (SELECT cluster_id, list_cosine_similarity(vec, qvec) AS score FROM embedded CROSS JOIN asked),
  top AS (SELECT * FROM s QUALIFY rank() OVER (ORDER BY round(score, 9) DESC) <= 5)
  SELECT cluster_id, round(greatest(max(score), 0.0), 9) AS score FROM top GROUP BY cluster_id"""))
def search_words(spark, folder):
    tags = topics.tag_table(model(spark, folder, "en").taggings)
    return search_text(QUERY_TEXT, tags)


@query("term_associations", f"""
  WITH {sql.TOKENS}, {sql.vocab()},
  placed AS (SELECT doc_id, unnest(t) AS term, unnest(range(0, len(t))) AS i FROM tokens),
  known AS (SELECT doc_id, i, term FROM placed JOIN vocab USING (term)),
  pairs AS (SELECT x.term AS term, y.term AS other, count(*) AS n FROM known x JOIN known y
            ON x.doc_id = y.doc_id AND y.i <> x.i AND abs(y.i - x.i) <= {meaning.WINDOW} GROUP BY ALL),
  sums AS (SELECT term, sum(n) AS s FROM pairs GROUP BY term),
  scored AS (SELECT p.term, other, n, ln(n * (SELECT sum(s) FROM sums)::DOUBLE / a.s / b.s) AS ppmi
             FROM pairs p JOIN sums a ON a.term = p.term JOIN sums b ON b.term = other)
  SELECT term, other, n, round(ppmi, 6) AS ppmi FROM scored WHERE ppmi > 1e-9""")
def term_associations(spark, folder):
    """Which terms stand near each other more often than chance has it?"""
    rows = stored_tokens(spark, folder)
    terms = vocabulary(rows)
    pairs = materialize(meaning.cooccurrences(rows, terms, TERMS), "pairs")
    found = meaning.ppmi(pairs, TERMS).where("ppmi > 1e-9")
    names = terms.select(F.col("term_id").cast("long").alias("a"), "term")
    others = terms.select(F.col("term_id").cast("long").alias("b"), F.col("term").alias("other"))
    named = found.join(broadcast_bounded(names, TERMS), "a").join(broadcast_bounded(others, TERMS), "b")
    return named.select("term", "other", "n", F.round("ppmi", 6).alias("ppmi"))


@query("search_meaning")
def search_related(spark, folder):
    """The clusters whose tags keep the same company as a word, by vectors learned from all documents."""
    rows = stored_tokens(spark, folder)
    terms = meaning.fit(rows, vocabulary(rows), TERMS)
    return search_meaning(QUERY_TEXT, topics.tag_table(model(spark, folder, "en").taggings), terms, TERMS)


STEPS, DOCUMENTS = 2, 5


def _folded(spark, folder):
    """Distributions of all documents over the smoothed topics of the ready clusters."""
    rows = stored_tokens(spark, folder)
    terms = [r["term"] for r in vocabulary(rows).select("term", "term_id").orderBy("term_id").collect()]  # at most TERMS
    attached = topics.attach_clusters(rows.select("doc_id", "tokens"), clusters(spark, folder))
    ids, found = fold_in.smoothed_topics(attached, terms)
    return ids, fold_in.distributions(rows, terms, found, STEPS)


_FOLDED = f"""WITH {sql.TOKENS}, {sql.vocab()},
  own AS (SELECT doc_id, term, p.tf FROM postings p JOIN vocab USING (term)),
  k AS (SELECT DISTINCT cluster_id AS c FROM tokens),
  cell AS (SELECT c, v.term, 1 + coalesce(n, 0) AS n FROM k CROSS JOIN vocab v LEFT JOIN
           (SELECT cluster_id, term, sum(tf) AS n FROM own JOIN tokens USING (doc_id) GROUP BY ALL) x ON x.cluster_id = c AND x.term = v.term),
  phi AS (SELECT c, term, n / sum(n) OVER (PARTITION BY c) AS p FROM cell),
  t0 AS (SELECT doc_id, c, 1.0 / (SELECT count(*) FROM k) AS w FROM tokens CROSS JOIN k),
  """ + ", ".join(
    f"""r{i} AS (SELECT doc_id, c, term, tf, w * p / sum(w * p) OVER (PARTITION BY doc_id, term) AS share
               FROM own JOIN t{i - 1} USING (doc_id) JOIN phi USING (c, term)),
  s{i} AS (SELECT doc_id, c, sum(tf * share) AS w FROM r{i} GROUP BY doc_id, c),
  t{i} AS (SELECT t.doc_id, t.c, coalesce(s.w / sum(s.w) OVER (PARTITION BY t.doc_id), t.w) AS w FROM t{i - 1} t LEFT JOIN s{i} s USING (doc_id, c))"""
    for i in range(1, STEPS + 1)
)


@query("topic_distribution", f"{_FOLDED} SELECT doc_id, c AS cluster_id, round(w, 6) AS weight FROM t{STEPS}")
def topic_distribution(spark, folder):
    ids, found = _folded(spark, folder)
    rows = found.select("doc_id", F.posexplode("topics").alias("at", "weight"))
    return rows.select("doc_id", F.element_at(F.lit(ids), F.col("at") + 1).alias("cluster_id"), F.round("weight", 6).alias("weight"))


@query("documents_by_topic", f"""{_FOLDED}
  SELECT c AS cluster_id, doc_id, CAST(row_number() OVER (PARTITION BY c ORDER BY round(w, 9) DESC, doc_id) AS INTEGER) AS rank
  FROM t{STEPS} QUALIFY rank <= {DOCUMENTS}""")
def documents_by_topic(spark, folder):
    """Relevant documents by their weight on a topic instead of the words of a cluster."""
    ids, found = _folded(spark, folder)
    ranked = fold_in.documents_of_topics(found, DOCUMENTS)
    return ranked.select(F.element_at(F.lit(ids), F.col("topic") + 1).alias("cluster_id"), "doc_id", "rank")


@query("lda_documents")
def lda_documents(spark, folder):
    """The heaviest documents of every fitted topic."""
    found = cluster.lda(tokens(spark, folder)).assignments
    return fold_in.documents_of_topics(found.select("doc_id", "topics"), DOCUMENTS)
