"""Text functions over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import corpus, language, lemmas
from docloom.plans import sql
from docloom.plans.pipeline import token_table
from docloom.plans.registry import query, table
from docloom.runtime import materialize, spread

# Lemma table of the check: a null lemma keeps the surface form.
LEMMAS = [("the", "The "), ("and", "und"), ("thes", "the"), ("les", "le"), ("des", "de"), ("her", None), ("ing", "")]
_LEMMA_ROWS = ", ".join(
    f"({sql.quoted(t)}, {'NULL' if m is None else sql.quoted(m)})" for t, m in LEMMAS
)


def documents(spark, folder):
    return spread(table(spark, folder, "documents"))


def tokens(spark, folder):
    """(doc_id, lang, cluster_id, tokens): cleaned, without stop words, numbers and blanks."""
    cluster = F.substring("source", 4, 10).cast("int").alias("cluster_id")
    raw = token_table(documents(spark, folder).select("doc_id", "lang", cluster, "text"), "text", sql.STOP_WORDS)
    return corpus.clean_tokens(
        raw.select("doc_id", "lang", "cluster_id", F.col("vector_no_stopw").alias("tokens"))
    )


def _per_document(name, output, column, check):
    @query(name, f"SELECT doc_id, {check} AS {output} FROM documents")
    def run(spark, folder):
        return documents(spark, folder).select("doc_id", column().alias(output))

    return run


text = lambda: F.col("text")
authors = lambda: F.replace(F.col("text"), F.lit(". "), F.lit(";"))
_AUTHORS = "replace(text, '. ', ';')"


def sections():
    """A document's lines as sections."""
    return F.transform(F.split("text", "\n", -1), lambda t: F.struct(t.alias("text"), F.lit("Body").alias("section")))


_per_document("flatten_sections", "body_text", lambda: tx.flatten_sections(sections()),
              "array_to_string(string_split(text, chr(10)), chr(10))")
_per_document("get_breaks", "broken", lambda: tx.get_breaks(text(), 40), sql.breaks("text"))
_per_document("abstract_summary", "summary", lambda: tx.abstract_summary(text()), sql.summary("text"))
_per_document(
    "format_authors", "authors", lambda: tx.format_authors(authors()),
    f"""CASE WHEN len(string_split({_AUTHORS}, ';')) > 2
        THEN {sql.breaks(f"replace({_AUTHORS}, ';', '. ')")} ELSE replace({_AUTHORS}, ';', '. ') END""",
)
_per_document("format_title", "title", lambda: tx.format_title(F.col("text"), 40), sql.breaks("text"))
_per_document("word_count", "n", lambda: tx.word_count(text()), f"CAST(len({sql.words('text')}) AS INTEGER)")
_per_document("unique_words", "n", lambda: tx.unique_words(text()),
              f"CAST(len(list_distinct({sql.words('text')})) AS INTEGER)")
_per_document("first_words", "head", lambda: tx.first_words(text(), 50), sql.first("text", 50))
_per_document("clean_text", "cleaned", lambda: tx.clean_text(text()), sql.clean("text"))


def _per_tokens(name, cte, expression, column):
    check = f"""WITH {sql.TOKENS} SELECT doc_id, CAST(len({expression}) AS INTEGER) AS n,
                array_to_string({expression}, '|') AS tokens FROM {cte}"""

    @query(name, check)
    def run(spark, folder):
        frame = column(token_table(documents(spark, folder).select("doc_id", "text"), "text", sql.STOP_WORDS))
        return frame.select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))

    return run


_per_tokens("tokenize", "toks", "v", lambda df: df.withColumn("t", F.col("vector")))
_per_tokens("remove_stopwords", "nostop", "w", lambda df: df.withColumn("t", F.col("vector_no_stopw")))
_per_tokens("drop_numeric", "toks", "list_filter(v, lambda x: NOT regexp_full_match(x, '[0-9]+'))",
            lambda df: df.withColumn("t", tx.drop_numeric(F.col("vector"))))
_per_tokens("clean_tokens", "tokens", "t",
            lambda df: corpus.clean_tokens(df.withColumn("t", F.col("vector_no_stopw")), "t"))


@query("drop_punct", f"""
  WITH s AS (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: NOT contains({sql.PUNCT}, x)) AS t
             FROM documents)
  SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, '|') AS tokens FROM s""")
def drop_punct(spark, folder):
    kept = tx.drop_punctuation(tx.space_words(F.col("text")))
    rows = documents(spark, folder).select("doc_id", kept.alias("t"))
    return rows.select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))


@query("lemmatize", f"""
  WITH {sql.TOKENS},
  lemma(token, lemma) AS (VALUES {_LEMMA_ROWS}),
  p AS (SELECT doc_id, unnest(v) AS token, generate_subscripts(v, 1) AS pos FROM toks)
  SELECT doc_id, string_agg(coalesce(trim(lower(lemma)), lower(token)), ' ' ORDER BY pos) AS text
  FROM p LEFT JOIN lemma USING (token) GROUP BY doc_id""")
def lemmatize(spark, folder):
    rows = token_table(documents(spark, folder).select("doc_id", "text"), "text", sql.STOP_WORDS)
    lemmas = spark.createDataFrame(LEMMAS, "token string, lemma string")
    return corpus.lemmatize(rows, lemmas, column="vector")


@query("processed_text", f"""
  WITH {sql.TOKENS},
  lemma(token, lemma) AS (VALUES {_LEMMA_ROWS}),
  p AS (SELECT doc_id, unnest(v) AS token, generate_subscripts(v, 1) AS pos FROM toks),
  l AS (SELECT doc_id, pos, coalesce(trim(lower(lemma)), lower(token)) AS w FROM p LEFT JOIN lemma USING (token))
  SELECT doc_id, coalesce(string_agg(w, ' ' ORDER BY pos)
           FILTER (WHERE w NOT IN ({sql.STOP_LIST}) AND NOT contains({sql.PUNCT}, w)), '') AS text
  FROM l GROUP BY doc_id""")
def processed_text(spark, folder):
    """Lemmas, then without stop words, then without punctuation, then one text again."""
    rows = token_table(documents(spark, folder).select("doc_id", "text"), "text", sql.STOP_WORDS)
    lemmas = spark.createDataFrame(LEMMAS, "token string, lemma string")
    return corpus.lemmatize(rows, lemmas, column="vector", words=sql.STOP_WORDS)


_MODEL = f"""
  words AS (SELECT lang, word, count(*) AS c
            FROM (SELECT lang, unnest(string_split(lower(text), ' ')) AS word FROM documents)
            WHERE word <> '' GROUP BY ALL),
  counts AS (SELECT lang, gram, CAST(sum(c) AS BIGINT) AS c
             FROM (SELECT lang, c, unnest({sql.ngrams('word', 1, 3)}) AS gram FROM words) GROUP BY ALL),
  profile AS (SELECT DISTINCT gram FROM counts),
  totals AS (SELECT lang, sum(c) AS n FROM counts GROUP BY lang),
  model AS (SELECT p.gram, t.lang, ln((coalesce(k.c, 0) + 1.0) / (t.n + (SELECT count(*) FROM profile))) AS score
            FROM profile p CROSS JOIN totals t LEFT JOIN counts k ON k.gram = p.gram AND k.lang = t.lang)"""


@query("language_model", f"WITH {_MODEL} SELECT gram, lang, round(score, 6) AS score FROM model")
def language_model(spark, folder):
    model = language.fit_language_model(documents(spark, folder))
    names = F.lit(model.languages)
    return model.grams.select("gram", F.posexplode("scores").alias("_i", "score")).select(
        "gram", F.get(names, F.col("_i")).alias("lang"), F.round("score", 6).alias("score")
    )


@query("detect_language", f"""
  WITH {_MODEL},
  heads AS (SELECT doc_id, unnest(list_slice(string_split(text, ' '), 1, 50)) AS word FROM documents),
  grams AS (SELECT doc_id, gram, count(*) AS c
            FROM (SELECT doc_id, unnest({sql.ngrams('lower(word)', 1, 3)}) AS gram FROM heads) GROUP BY ALL),
  scored AS (SELECT doc_id, lang, sum(c * score) AS score FROM grams JOIN model USING (gram) GROUP BY ALL),
  best AS (SELECT doc_id, lang, score FROM scored
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)
  SELECT d.doc_id, coalesce(b.lang, 'unknown') AS language, round(b.score, 4) AS score
  FROM documents d LEFT JOIN best b USING (doc_id)""")
def detect_language(spark, folder):
    docs = documents(spark, folder)
    model = language.fit_language_model(docs)
    papers = docs.select(
        "doc_id", F.col("text").alias("body_text"), tx.abstract_summary(F.col("text")).alias("abstract_summary")
    )
    return language.detect_language(papers, model).select(
        "doc_id", "language", F.round("score", 4).alias("score")
    )


# Endings that are taken off where what remains is a word of the corpus too
ENDINGS = ("s", "es", "e", "en", "er", "ing", "tion", "ment")
_HALF = f"{sql.md5_number('token')} % 2"
_PAIRS = f"""WITH {sql.TOKENS},
  voc AS (SELECT DISTINCT unnest(t) AS token FROM tokens),
  ends(e) AS (VALUES {', '.join(f"('{e}')" for e in ENDINGS)}),
  cut AS (SELECT token, e, substr(token, 1, length(token) - length(e)) AS stem FROM voc JOIN ends ON suffix(token, e) AND length(token) - length(e) >= 3),
  stems AS (SELECT token, arg_max(stem, length(e)) AS lemma FROM cut WHERE stem IN (SELECT token FROM voc) GROUP BY token),
  pairs AS (SELECT token, coalesce(lemma, token) AS lemma FROM voc LEFT JOIN stems USING (token) WHERE {_HALF} = 0),
  votes AS (SELECT ending, replacement, count(*) AS support FROM (
              SELECT substr(token, length(lemma) - m + 1) AS ending, substr(lemma, length(lemma) - m + 1) AS replacement
              FROM pairs, range(0, {lemmas.CONTEXT + 1}) r(m) WHERE m <= length(lemma)) WHERE length(ending) <= {lemmas.LONGEST} GROUP BY ALL),
  totals AS (SELECT right(token, n) AS ending, count(*) AS total FROM pairs, range(0, {lemmas.LONGEST + 1}) r(n) WHERE n <= length(token) GROUP BY ALL),
  best AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY ending ORDER BY support DESC, replacement) = 1),
  rules AS (SELECT ending, replacement, support, total FROM best JOIN totals USING (ending)
            WHERE support >= {lemmas.SUPPORT} AND support >= {lemmas.SHARE} * total)"""


def _vocabulary_pairs(spark, folder):
    """(token, lemma, half): words of the corpus with the words that they are without an ending."""
    words = materialize(tokens(spark, folder).select(F.explode(F.array_distinct("tokens")).alias("token")).distinct(), "words")  # two joins read them
    cut = words.select(
        "token", F.explode(F.array_compact(F.array(*[
            F.when(F.endswith("token", F.lit(e)) & (F.length("token") >= len(e) + 3), F.struct(F.lit(len(e)).alias("n"), F.substr("token", F.lit(1), F.length("token") - len(e)).alias("stem")))
            for e in ENDINGS
        ]))).alias("c")
    ).select("token", "c.*")
    stems = cut.join(words.select(F.col("token").alias("stem")), "stem").groupBy("token").agg(F.max_by("stem", "n").alias("lemma"))
    half = F.conv(F.substring(F.md5(F.col("token").cast("binary")), 1, 8), 16, 10).cast("long") % 2
    return words.join(stems, "token", "left").select("token", F.coalesce("lemma", "token").alias("lemma"), half.alias("half"))


@query("lemma_rules", f"{_PAIRS} SELECT ending, replacement, support, total FROM rules")
def lemma_rules(spark, folder):
    """Rules learned from half of the vocabulary."""
    return lemmas.learn_rules(materialize(_vocabulary_pairs(spark, folder), "pairs").where("half = 0"))


@query("learned_lemmas", f"""{_PAIRS},
  held AS (SELECT token FROM voc WHERE {_HALF} = 1)
  SELECT token, coalesce(arg_max(left(token, length(token) - length(ending)) || replacement, length(ending)), token) AS lemma
  FROM held LEFT JOIN rules ON suffix(token, ending) GROUP BY token""")
def learned_lemmas(spark, folder):
    """Lemmas of the other half, which the rules have not seen."""
    pairs = materialize(_vocabulary_pairs(spark, folder), "pairs")
    rules, exceptions = lemmas.learn(pairs.where("half = 0"))
    held = pairs.where("half = 1").select("token", F.array("token").alias("tokens"))
    return lemmas.apply_rules(held, rules, exceptions).select("token", F.get("lemmas", F.lit(0)).alias("lemma"))
