"""Lemmas by suffix rules that are learned from (token, lemma) pairs.

A pair that differs after its longest common prefix shows a rewrite of the token's end. It votes for
rules with up to ``CONTEXT`` letters of what stays in front: cities -> city votes for "ies" -> "y", "ties" -> "ty" and so on; an unchanged
pair votes for leaving its endings as they are. A rule stands when enough pairs support it, and enough of the pairs with that
ending. The longest ending that has a rule decides. Pairs that the rules get wrong become exceptions, which go first.

Votes are counted by joins and aggregations. Rules and exceptions travel to the texts, whose tokens are rewritten
where they are: counted first, and within ``MODEL_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.runtime import MODEL_BYTES, materialize

CONTEXT = 3
LONGEST = 8
SUPPORT = 3
SHARE = 0.6
ENTRY_BYTES = 256


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading characters that two strings share."""
    most = F.least(F.length(a), F.length(b))
    places = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    other = F.filter(places, lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.coalesce(F.get(other, F.lit(0)) - 1, most)


def endings(token: Column) -> Column:
    """All endings of a token of up to ``LONGEST`` letters, the empty one included."""
    return F.transform(F.sequence(F.lit(0), F.least(F.length(token), F.lit(LONGEST))), lambda n: F.substr(token, F.length(token) - n + 1, n))


def learn_rules(pairs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """(ending, replacement, support, total): the rule of each ending; ``pairs`` are (token, lemma), once each."""
    kept = pairs.select("token", "lemma", common_prefix(F.col("token"), F.col("lemma")).alias("same"))
    lengths = F.sequence(F.lit(0), F.least("same", F.lit(CONTEXT)))
    votes = kept.select("token", "lemma", "same", F.explode(lengths).alias("more")).select(
        F.substr("token", F.col("same") - F.col("more") + 1).alias("ending"), F.substr("lemma", F.col("same") - F.col("more") + 1).alias("replacement")
    )
    votes = votes.where(F.length("ending") <= LONGEST).groupBy("ending", "replacement").agg(F.count("*").alias("support"))
    totals = pairs.select(F.explode(endings(F.col("token"))).alias("ending")).groupBy("ending").agg(F.count("*").alias("total"))
    first = Window.partitionBy("ending").orderBy(F.desc("support"), "replacement")  # the replacements of one ending
    best = votes.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
    rules = best.join(totals, "ending")
    return rules.where((F.col("support") >= support) & (F.col("support") >= share * F.col("total")))


def apply_rules(df: DataFrame, rules: DataFrame, exceptions: DataFrame | None = None, column: str = "tokens", output: str = "lemmas") -> DataFrame:
    """``df`` with ``output``: the lemma of every token of an array column, in order. Map-only."""
    known = [(rules, "ending", "replacement")] + ([(exceptions, "token", "lemma")] if exceptions is not None else [])
    tables = []
    for frame, key, value in known:
        if frame.count() * ENTRY_BYTES > MODEL_BYTES:
            raise ValueError(f"rules or exceptions exceed {MODEL_BYTES} bytes: raise the support")
        tables.append({r[key]: r[value] for r in frame.select(key, value).collect()})
    shared = df.sparkSession.sparkContext.broadcast(tables)
    fields = [f for f in df.schema if f.name != output]
    at = [f.name for f in fields].index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules_of, *odd = shared.value

        def lemma(token: str) -> str:
            if odd and token in odd[0]:
                return odd[0][token]
            for n in range(min(len(token), LONGEST), -1, -1):
                ending = token[len(token) - n :]
                if ending in rules_of:
                    return token[: len(token) - n] + rules_of[ending]
            return token

        for batch in batches:
            tokens = batch.column(at)
            flat = tokens.flatten().dictionary_encode()  # each different token of a batch once
            found = pa.array([lemma(t) for t in flat.dictionary.to_pylist()], pa.string()).take(flat.indices)
            ends = pa.array([0, *tokens.value_lengths().fill_null(0).to_numpy().cumsum()], pa.int32())
            lists = pa.ListArray.from_arrays(ends, found, mask=tokens.is_null())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*(f.name for f in fields), output])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{output}` array<string>"])
    return df.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(run, schema)


def learn(pairs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(rules, exceptions) of (token, lemma); a token with several lemmas has its smallest."""
    once = materialize(pairs.groupBy("token").agg(F.min("lemma").alias("lemma")), "lemma-pairs")
    rules = materialize(learn_rules(once, support, share), "lemma-rules")
    judged = apply_rules(once.withColumn("tokens", F.array("token")), rules)
    wrong = judged.where(F.get("lemmas", F.lit(0)) != F.col("lemma"))
    return rules, materialize(wrong.select("token", "lemma"), "lemma-exceptions")
