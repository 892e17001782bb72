"""Secret scan behind a trigram inverted index.

Every rule is a regular expression. From its syntax tree follows a Boolean query of trigrams
that any matching text must hold; postings of the queried trigrams are intersected per
document, and only the candidates of a rule are searched with its expression. A rule without
mandatory trigrams (runs of hex digits) searches every text. DataFrame functions only;
deriving a query is done once per rule on the driver and sees no data.

The index is over text with A-Z folded to a-z, so it serves rules of either case. Postings
are (trigram, id) rows for the trigrams that some rule asks for. Texts never move: candidates
come back to the documents by a join on ids, broadcast after a count.

Matches are leftmost and non-overlapping for each kind; a match that is too short is
dropped after it has consumed its text. Offsets count code points, ends are exclusive.

Edge cases: a null or empty text has no spans; a row with a null id is searched by
every rule; rows that share an id share their candidacy and are searched each for itself;
texts of any length are searched whole; an empty table gives an empty result; a column named
``spans`` in the input is replaced, those with the prefix ``_s_`` of working columns are left
out, others are carried through.
"""

from __future__ import annotations

import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as code

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import fold_ascii
from docloom.runtime import BROADCAST_BYTES, materialize

MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``least`` characters in ``group`` make a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three kinds of the contract, in its order. For access and hex the least
# length stands in the pattern: their runs are maximal, so nothing else can match.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Published shapes of credentials that carry their own prefix
EXTRA = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE + EXTRA

# A Boolean query: True (no condition), a trigram, or ("and" | "or", parts)
Query = bool | str | tuple
MOST_STRINGS = 64


def _both(a: Query, b: Query) -> Query:
    if a is True or a == b:
        return b
    return a if b is True else ("and", (a, b))


def _either(parts: Sequence[Query]) -> Query:
    parts = tuple(dict.fromkeys(parts))
    if True in parts:
        return True
    return parts[0] if len(parts) == 1 else ("or", parts)


def _grams_of(strings: set[str]) -> Query:
    """What holds for a text with one of these strings in it."""
    if not strings or min(map(len, strings)) < 3:
        return True
    return _either([reduce(_both, [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _small(char: int) -> str:
    return chr(char + 32 if 65 <= char <= 90 else char)


def _strings(tree) -> set[str] | None:
    """All strings a piece can match, if they are few; else None."""
    found = {""}
    for op, arg in tree:
        if op is code.LITERAL:
            more = {_small(arg)}
        elif op is code.IN:
            more = set()
            for kind, value in arg:
                if kind is code.LITERAL:
                    more.add(_small(value))
                elif kind is code.RANGE and value[1] - value[0] < 4:
                    more |= {_small(c) for c in range(value[0], value[1] + 1)}
                else:
                    return None
        elif op is code.SUBPATTERN:
            more = _strings(arg[3])
        elif op is code.BRANCH:
            parts = [_strings(p) for p in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op is code.MAX_REPEAT and arg[1] <= 4:
            one = _strings(arg[2])
            more = None if one is None else set().union(*(_power(one, n) for n in range(arg[0], arg[1] + 1)))
        else:
            return None
        if more is None:
            return None
        found = {a + b for a in found for b in more}
        if len(found) > MOST_STRINGS:
            return None
    return found


def _power(strings: set[str], n: int) -> set[str]:
    out = {""}
    for _ in range(n):
        out = {a + b for a in out for b in strings}
    return out


def _query_of(tree) -> Query:
    query, run = True, {""}
    for op, arg in tree:
        own = _strings([(op, arg)])
        if own is not None and len(longer := {a + b for a in run for b in own}) <= MOST_STRINGS:
            run = longer
            continue
        query, run = _both(query, _grams_of(run)), {""}
        if op is code.SUBPATTERN:
            query = _both(query, _query_of(arg[3]))
        elif op is code.BRANCH:
            query = _both(query, _either([_query_of(p) for p in arg[1]]))
        elif op is code.MAX_REPEAT and arg[0] > 0:
            query = _both(query, _query_of(arg[2]))
    return _both(query, _grams_of(run))


def trigram_query(pattern: str) -> Query:
    """The trigrams (lower case) that every text matched by ``pattern`` holds."""
    return _query_of(list(parser.parse(pattern)))


def grams_in(query: Query) -> set[str]:
    if isinstance(query, bool):
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_in, query[1]))


def build_index(docs: DataFrame, grams: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (gram, id) of the given trigrams; one pass over the text, nothing shuffled."""
    folded = docs.select(F.col(id_col).alias("id"), fold_ascii(F.col(text_col)).alias("folded")).where(F.col("id").isNotNull())
    held = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in grams]))
    return folded.select("id", F.explode(held).alias("gram")).select("gram", "id")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """Intersect postings: (id, kinds) for each id that satisfies the query of some kind.

    A set of at most a few dozen trigrams per id is combined map-side, as bits.
    """
    grams = sorted(set().union(*map(grams_in, queries.values())))
    words = [grams[i : i + 60] for i in range(0, len(grams), 60)]
    place = {g: (w, b) for w, part in enumerate(words) for b, g in enumerate(part)}

    def bits(part):
        bit = F.lit(0).cast("long")
        for b, g in enumerate(part):
            bit = F.when(F.col("gram") == g, F.lit(1 << b).cast("long")).otherwise(bit)
        return bit

    sets = index.groupBy("id").agg(*[F.bit_or(bits(part)).alias(f"w{w}") for w, part in enumerate(words)])

    def holds(query) -> Column:
        if isinstance(query, str):
            w, b = place[query]
            return F.col(f"w{w}").bitwiseAND(F.lit(1 << b)) != 0
        parts = [holds(q) for q in query[1]]
        return reduce(Column.__and__ if query[0] == "and" else Column.__or__, parts)

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return sets.select("id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, ord, end, kind>> of a rule's matches in ``text``."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    kind = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["between"])
        end = begin + F.length(x["whole"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = F.when(F.length(x["counted"]) >= rule.least, F.array(span)).otherwise(F.array().cast(kind))
        return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], kept.cast(kind)).alias("out"))

    # the text after the last match is one more piece
    zipped = F.arrays_zip(
        F.slice(between, 1, F.size(whole)).alias("between"), whole.alias("whole"), counted.alias("counted")
    )
    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array<struct<start, ord, end, kind>>, by start and then by the order of the rules."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    full = {k for k, q in queries.items() if q is True}
    queries = {k: q for k, q in queries.items() if q is not True}
    docs = docs.drop("spans", *[c for c in docs.columns if c.startswith("_s_")])
    kinds = F.array().cast("array<string>")
    if queries:
        grams = sorted(set().union(*map(grams_in, queries.values())))
        found = materialize(candidates(build_index(docs, grams, id_col, text_col), queries), "secret-candidates")
        found = found.withColumnsRenamed({"id": "_s_id", "kinds": "_s_kinds"})
        n = found.count()
        # past the bound the documents are joined by a shuffle on their ids
        found = F.broadcast(found) if n * 128 <= BROADCAST_BYTES else found
        docs = docs.join(found, F.col(id_col) == F.col("_s_id"), "left").drop("_s_id")
        kinds = F.col("_s_kinds")
    none = F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>")
    text = F.col(text_col)
    parts = []
    for order, rule in enumerate(rules):
        wanted = text.rlike(rule.pattern)
        if rule.kind not in full:
            wanted = (F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)) | F.col(id_col).isNull()) & wanted
        parts.append(F.when(wanted, find_spans(text, rule, order)).otherwise(none))
    return docs.withColumn("spans", F.array_sort(F.concat(*parts))).drop("_s_kinds")


def joined(spans: Column) -> Column:
    """kind:start:end of every span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def united(spans: Column) -> Column:
    """array<struct<start, end>>: sorted spans with overlapping ones made one."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def step(acc, s):
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (s["start"] >= last["end"])
        one = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        longer = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(apart, F.concat(acc, one)).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), longer)).cast(kind)

    return F.aggregate(spans, F.array().cast(kind), step)


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = None, by: str = MASK) -> DataFrame:
    """``docs`` (with ``spans``) with every span of the text replaced; ``length_col`` follows where the text changed."""
    rows = docs.withColumn("_s_united", united(F.col("spans")))

    def gap(s, i):
        before = F.when(i == 0, F.lit(0)).otherwise(F.get("_s_united", i - 1)["end"])
        return F.substr(F.col(text_col), (before + 1).cast("int"), (s["start"] - before).cast("int"))

    rest = F.substr(F.col(text_col), (F.element_at("_s_united", -1)["end"] + 1).cast("int"))
    changed = F.size("_s_united") > 0
    whole = F.array_join(F.concat(F.transform("_s_united", gap), F.array(rest)), by)
    columns = {text_col: F.when(changed, whole).otherwise(F.col(text_col))}
    if length_col is not None:
        cut = F.aggregate("_s_united", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"] - len(by))
        columns[length_col] = F.when(changed, F.length(text_col) - cut).otherwise(F.col(length_col))
    return rows.withColumns(columns).drop("_s_united")
