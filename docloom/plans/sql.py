"""Fragments of the check SQL (DuckDB dialect)."""

from __future__ import annotations

from docloom.functions.text import CUSTOM_STOP_WORDS, PUNCTUATION, stop_words

# The English stop words that Spark ships, as loaded by
# StopWordsRemover.loadDefaultStopWords("english"), in its order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split(" ")

STOP_WORDS = stop_words(ENGLISH_STOP_WORDS, CUSTOM_STOP_WORDS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_LIST = ", ".join(quoted(w) for w in STOP_WORDS)
PUNCT = quoted(PUNCTUATION)


def breaks(text: str, length: int = 40) -> str:
    """get_breaks as a fold over space-separated words."""
    over = f"acc.n + length(w) > {length}"
    return f"""list_reduce(string_split({text}, ' '),
      lambda acc, w: {{'s': acc.s || (CASE WHEN {over} THEN '<br>' ELSE ' ' END) || w,
                       'n': CASE WHEN {over} THEN 0 ELSE acc.n + length(w) END}},
      {{'s': '', 'n': 0::BIGINT}}).s"""


def first(text: str, n: int) -> str:
    return f"array_to_string(list_slice(string_split({text}, ' '), 1, {n}), ' ')"


def summary(text: str) -> str:
    return f"""CASE WHEN {text} = '' THEN 'Not provided.'
      WHEN len(string_split({text}, ' ')) > 100 THEN {breaks(first(text, 100))} || '...'
      ELSE {breaks(text)} END"""


def words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[\s\p{{Z}}]+'), lambda w: w <> '')"


def clean(text: str) -> str:
    return rf"""regexp_replace(regexp_replace(regexp_replace(lower({text}), '^rt ', ''),
      'https?://\S+', '', 'g'), '[^a-zA-Z0-9\s]', '', 'g')"""


# documents -> cleaned text -> tokens v -> without stop words w -> without numbers and blanks t
TOKENS = rf"""
  cleaned AS (SELECT doc_id, lang, CAST(substr(source, 4) AS INTEGER) AS cluster_id,
                     {clean('text')} AS c FROM documents),
  split AS (SELECT doc_id, lang, cluster_id, regexp_replace(c, '\s+$', '') AS s, c FROM cleaned),
  toks AS (SELECT doc_id, lang, cluster_id,
                  CASE WHEN s = '' AND c <> '' THEN []::VARCHAR[]
                       ELSE string_split_regex(s, '\s') END AS v FROM split),
  nostop AS (SELECT *, list_filter(v, lambda x: x NOT IN ({STOP_LIST})) AS w FROM toks),
  tokens AS (SELECT doc_id, lang, cluster_id, t FROM (
      SELECT *, list_filter(w, lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+')) AS t
      FROM nostop) WHERE len(t) > 0)"""


def vocab(max_terms: int = 5000, min_df: int = 5, source: str = "tokens") -> str:
    """CTEs postings, stats, vocab, weights on top of a CTE (doc_id, t)."""
    return f"""
  postings AS (SELECT doc_id, term, count(*) AS tf
               FROM (SELECT doc_id, unnest(t) AS term FROM {source}) GROUP BY ALL),
  stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM postings GROUP BY term),
  vocab AS (SELECT term, tf, df, CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS INTEGER) AS term_id
            FROM stats WHERE df >= {min_df} QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= {max_terms}),
  weights AS (SELECT term, term_id, ln(((SELECT count(*) FROM {source}) + 1.0) / (df + 1.0)) AS idf FROM vocab)"""


# per-cluster topic on top of TOKENS and vocab()
TOPICS = """
  cterms AS (SELECT cluster_id, term, count(*) AS tf
             FROM (SELECT cluster_id, unnest(t) AS term FROM tokens) GROUP BY ALL),
  csum AS (SELECT cluster_id, term, tf * idf AS s FROM cterms JOIN weights USING (term)),
  topics AS (SELECT cluster_id, term,
                    (1.0 + s) / ((SELECT count(*) FROM vocab) + sum(s) OVER (PARTITION BY cluster_id)) AS weight
             FROM csum),
  known AS (SELECT k.cluster_id, coalesce(sum(s), 0) AS total
            FROM (SELECT DISTINCT cluster_id FROM cleaned) k LEFT JOIN csum USING (cluster_id) GROUP BY k.cluster_id),
  every AS (SELECT k.cluster_id, v.term, coalesce(t.weight, 1.0 / ((SELECT count(*) FROM vocab) + k.total)) AS weight
            FROM known k CROSS JOIN vocab v LEFT JOIN topics t ON t.cluster_id = k.cluster_id AND t.term = v.term),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term) AS INTEGER) AS rank
             FROM every)"""

# embeddings with their label and the label means
VECTORS = """
  v AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS vec, label AS cluster_id FROM embeddings),
  cell AS (SELECT doc_id, cluster_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
  mean AS (SELECT cluster_id, i, avg(x) AS x FROM cell GROUP BY ALL),
  centre AS (SELECT cluster_id AS c, list(x ORDER BY i) AS cvec FROM mean GROUP BY cluster_id)"""

ASSIGNED = """
  gap AS (SELECT doc_id, vec, c, power(list_distance(vec, cvec), 2) AS d2 FROM v CROSS JOIN centre),
  assigned AS (SELECT doc_id, vec, c AS cluster_id, d2 FROM gap
               QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d2, c) = 1)"""


def silhouette(source: str, power: int) -> str:
    """CTEs per_cluster, point, sil over a CTE (k, doc_id, vec, cluster_id)."""
    return f"""
  per_cluster AS (
    SELECT a.k, a.doc_id, a.cluster_id AS own, b.cluster_id AS other,
           sum(power(list_distance(a.vec, b.vec), {power})) AS total, count(*) AS n
    FROM {source} a JOIN {source} b ON a.k = b.k GROUP BY ALL),
  point AS (
    SELECT k, doc_id, max(CASE WHEN own = other THEN n END) AS n,
           max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
           min(CASE WHEN own <> other THEN total / n END) AS b
    FROM per_cluster GROUP BY k, doc_id),
  sil AS (SELECT k, avg(CASE WHEN n = 1 THEN 0.0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b)
                        ELSE 0.0 END) AS silhouette FROM point GROUP BY k)"""


def md5_number(*parts: str) -> str:
    """First 32 bits of the md5 of the parts joined by colons."""
    joined = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT)"


def ngrams(word: str, low: int, high: int) -> str:
    """Character n-grams of the space-padded word, without the bare space."""
    padded = f"(' ' || {word} || ' ')"
    parts = [
        f"list_transform(range(1, length({padded}) - {n} + 2), lambda p: substr({padded}, p, {n}))"
        for n in range(low, high + 1)
    ]
    joined = parts[0] if len(parts) == 1 else "flatten([" + ", ".join(parts) + "])"
    return f"list_filter({joined}, lambda g: g <> ' ')"


def embed(text: str, dim: int = 64) -> str:
    """Counts of md5-hashed trigrams."""
    bucket = f"list_transform({ngrams(f'lower({text})', 3, 3)}, lambda g: CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) % {dim})"
    return f"""list_transform(range(0, {dim}), lambda i: CAST(len(list_filter({bucket}, lambda x: x = i)) AS DOUBLE))"""
