"""Personal data: identifiers of known shape, and unseen ones by bootstrapped context patterns.

Four expressions find e-mail addresses, IP addresses, card numbers and telephone numbers. These base spans
are the seeds. One more expression finds mentions: anything that has the look of an identifier (an @, or at least
four digits). A mention that is a seed carries its kind; the others are unknown.

Each mention has context patterns: its two words to the left, and the word on either side. Contexts are
windows of ``WINDOW`` code points that end at the next mention. Patterns and instances (normalised mentions)
form a bipartite graph, scored in rounds until no score moves:

* the confidence of (pattern, kind) is the sum of its instances' scores for the kind over the
  number of its instances of a fitting shape plus one, if that sum reaches ``SUPPORT``;
* the score of (instance, kind) is one minus the product of (1 - confidence) over its patterns of ``TRUSTED``
  confidence; a seed has 1 for its kind and 0 for the others.

Unknown instances that reach ``ACCEPT`` become spans wherever they occur, unless base spans are
there. Seeds keep their scores, so the graph needs the number of seeds for each pattern and the edges of unknown
mentions only: it grows with these, not with the text. An instance counts once for a pattern, however
often copies of a document repeat it.

DataFrame functions only. The text is read once and does not move: spans and mentions are written to the
shared folder and everything after it works on them. Counts are combined before they are shuffled, and
joins have one row per key on one side.

Spans of a kind are leftmost and non-overlapping; a match that fails its check is dropped after it has
consumed its text. The expressions are written so that no text makes them slow (possessive runs that
start where a run starts), and give what the plain ones do. Offsets count code points, ends are exclusive.

Edge cases: a null or empty text has no spans; null and repeated ids keep a row each; texts of any length are
searched whole; an empty table gives an empty result; the named columns are read, any others are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import fold_ascii
from docloom.runtime import BROADCAST_BYTES, forget, materialize

KINDS = ("email", "ip", "card", "phone")
# The shapes of the contract, as possessive runs
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?+[0-9]){11,18}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD = rf"(?<![0-9])(?<![0-9][\x20-]){_CARD}(?![\x20-]?[0-9])"
PATTERNS = {"email": rf"(?:(?<![A-Za-z0-9._%+-])|\G){_EMAIL}", "ip": rf"(?<![0-9]){_IP}", "card": CARD, "phone": _PHONE}

_RUN = r"A-Za-z0-9@._%+/:-"
_LOOK = r"(?=(?:[A-Za-z@._%+/:-]*+[0-9]){4}|[A-Za-z0-9._%+/:-]++@)"
MENTION = rf"{_PHONE}|{CARD}|(?<![{_RUN}]){_LOOK}[{_RUN}]*[A-Za-z0-9]"
WORD = r"[^\x20\x09-\x0D]+"
# kinds that an unknown mention of a shape may take
FITS = {"at": ("email",), "dotted": ("ip",), "digits": ("card", "phone")}

WINDOW = 80
SUPPORT = 3.0
TRUSTED = 0.6
ACCEPT = 0.8
MOVED = 0.001
ROUNDS = 50
STEP = 256

SPANS = "array<struct<start:bigint,ord:int,end:bigint,kind:string,by:string>>"


@dataclass(frozen=True)
class Extraction:
    """``spans``: (id, spans) for each text; ``patterns``: (context, kind, support, confidence) of the last round."""

    spans: DataFrame
    patterns: DataFrame


def running(lengths: Column) -> Column:
    """Running sums of an array, in steps so that long arrays are not copied once per element."""

    def inside(block):
        none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

        def add(acc, n):
            at = (acc["at"] + n).cast("long")
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

        return F.aggregate(block, none, add, lambda acc: acc["out"])

    starts = F.when(F.size(lengths) > 0, F.sequence(F.lit(1), F.size(lengths), F.lit(STEP))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda k: inside(F.slice(lengths, k, F.lit(STEP))))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))

    def chain(acc, block):
        moved = F.transform(block, lambda v: v + acc["at"])
        return F.struct((acc["at"] + F.element_at(block, -1)).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    return F.flatten(F.aggregate(blocks, none, chain, lambda acc: acc["out"]))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits have a right check digit?"""

    def add(total, i):
        digit = F.substr(number, F.length(number) - i, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 0, digit).when(double > 9, double - 9).otherwise(double)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """The check that a match of the kind's expression must pass."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(digits(match)).between(12, 19) & luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


def _located(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """For each (name, pattern): ``<name>_w`` matches, ``<name>_b`` texts between them, ``<name>_e`` ends of matches."""
    empty = F.array().cast("array<string>")
    rows = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"{n}_w") for n, p in names.items()])
    # the second search is for texts with a match only
    rows = rows.select(
        "*", *[F.when(F.size(f"{n}_w") > 0, F.split("text", p, -1)).otherwise(empty).alias(f"{n}_b") for n, p in names.items()]
    )
    # a column of its own, so that the running sums do not compute it for every step
    lengths = {n: F.zip_with(f"{n}_w", F.slice(f"{n}_b", 1, F.size(f"{n}_w")), lambda w, b: F.length(w) + F.length(b)) for n in names}
    rows = rows.select("*", *[lengths[n].alias(f"{n}_l") for n in names])
    return rows.select("*", *[F.when(F.size(f"{n}_w") > 0, running(F.col(f"{n}_l"))).alias(f"{n}_e") for n in names])


def base_spans() -> Column:
    """array of the four kinds' spans, by start and then kind."""

    def spans(order, kind):
        def span(match, end):
            found = F.struct(
                (end - F.length(match)).cast("long").alias("start"), F.lit(order).alias("ord"), end.cast("long").alias("end"),
                F.lit(kind).alias("kind"), F.lit("base").alias("by"),
            )
            return F.when(holds(kind, match), found)

        return F.coalesce(F.array_compact(F.zip_with(f"{kind}_w", f"{kind}_e", span)), F.array().cast(SPANS))

    return F.array_sort(F.concat(*[spans(order, kind) for order, kind in enumerate(KINDS)]))


def label(mention: Column) -> Column:
    """The kind of a mention that is a seed as a whole, else null."""
    whole = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
    found = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        found = F.when(mention.rlike(rf"\A(?:{whole[kind]})\z") & holds(kind, mention), F.lit(kind)).otherwise(found)
    return found


def shape(mention: Column) -> Column:
    dotted = mention.rlike(r"\A[0-9A-Fa-f]++(?:[.:][0-9A-Fa-f]++){2,}+\z") & mention.rlike(r"[0-9]")
    numeric = mention.rlike(r"\A\+?[0-9][0-9\x20().-]*\z")
    return F.when(mention.contains("@"), F.lit("at")).when(dotted, F.lit("dotted")).when(numeric, F.lit("digits"))


def mentions() -> Column:
    """array<struct<start, end, inst, label, shape, contexts>> of the mentions of a fitting shape."""

    def words(piece):
        return F.regexp_extract_all(F.regexp_replace(fold_ascii(piece), "[0-9]", "0"), F.lit(WORD), F.lit(0))

    def mention(i):
        raw, end = F.get("mention_w", i), F.get("mention_e", i)
        # a run may begin with marks; the identifier begins after them
        text = F.regexp_replace(raw, r"\A[^A-Za-z0-9+]+", "")
        left, right = words(F.right(F.get("mention_b", i), F.lit(WINDOW))), words(F.left(F.get("mention_b", i + 1), F.lit(WINDOW)))
        near = F.coalesce(F.try_element_at(left, F.lit(-1)), F.lit("^"))
        far = F.coalesce(F.try_element_at(left, F.lit(-2)), F.lit("^"))
        after = F.coalesce(F.try_element_at(right, F.lit(1)), F.lit("$"))
        of_shape = shape(text)
        return F.struct(
            (end - F.length(text)).cast("long").alias("start"), end.cast("long").alias("end"),
            F.when(of_shape == "digits", digits(text)).otherwise(F.lower(text)).alias("inst"),
            label(text).alias("label"), of_shape.alias("shape"),
            F.array(F.concat_ws(" ", far, near, F.lit("_")), F.concat_ws(" ", near, F.lit("_"), after)).alias("contexts"),
        )

    count = F.size("mention_w")
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    found = F.transform(places, mention)
    return F.filter(found, lambda m: m["shape"].isNotNull() & (m["label"].isNotNull() | ~_holds_seed(m["inst"])))


def _holds_seed(instance: Column) -> Column:
    """Is there an address inside a longer run? The base spans have it already."""
    return instance.rlike(PATTERNS["email"]) | instance.rlike(PATTERNS["ip"])


def read_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, base, mentions), written once; the only pass over the text."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _located(rows, PATTERNS | {"mention": MENTION})
    rows = rows.select("id", base_spans().alias("base"), mentions().alias("mentions"))
    return materialize(rows.withColumn("key", F.monotonically_increasing_id()), "pii-mentions")


def score(mentioned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patterns, scores) of the graph of mentions (inst, label, shape, contexts): both written tables."""
    pairs = mentioned.select("inst", "label", "shape", F.explode("contexts").alias("context")).distinct()
    pairs = materialize(pairs, "pii-pairs")
    kinds = F.create_map(*[x for s, ks in FITS.items() for x in (F.lit(s), F.array(*map(F.lit, ks)))])
    edges = pairs.where("label IS NULL").select("context", "inst", F.explode(kinds[F.col("shape")]).alias("kind"))
    edges = materialize(edges, "pii-edges")
    # instances of a shape that fits the kind, and those that are seeds of it
    known = pairs.select("context", "label", F.explode(kinds[F.col("shape")]).alias("kind"))
    counts = known.groupBy("context", "kind").agg(F.count("*").alias("total"), F.count_if(F.col("label") == F.col("kind")).alias("seeds"))
    counts = materialize(counts.join(edges.select("context", "kind").distinct(), ["context", "kind"], "left_semi"), "pii-patterns")
    scores, total = materialize(edges.select("inst", "kind").distinct().withColumn("score", F.lit(0.0)), "pii-scores"), 0.0
    for _ in range(ROUNDS):
        patterns = _patterns(edges, counts, scores)
        trusted = patterns.where(F.col("confidence") >= TRUSTED)
        gained = edges.join(trusted, ["context", "kind"]).groupBy("inst", "kind")
        after = gained.agg(F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 9).alias("score"))
        before, scores = scores, materialize(after, "pii-scores")
        forget(before)
        previous, total = total, scores.agg(F.sum("score")).first()[0] or 0.0
        if total - previous < MOVED:
            break
    return materialize(_patterns(edges, counts, scores), "pii-confidence"), scores


def _patterns(edges: DataFrame, counts: DataFrame, scores: DataFrame) -> DataFrame:
    gained = edges.join(scores, ["inst", "kind"]).groupBy("context", "kind").agg(F.sum("score").alias("gained"))
    support = F.round(F.col("seeds") + F.coalesce("gained", F.lit(0.0)), 9)
    rows = counts.join(gained, ["context", "kind"], "left").withColumn("support", support)
    rows = rows.where(F.col("support") >= SUPPORT)
    return rows.select("context", "kind", "support", (F.col("support") / (F.col("total") + 1)).alias("confidence"))


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Extraction:
    """All spans of each text: base ones, and unknown identifiers that trusted patterns point out."""
    read = read_mentions(docs, id_col, text_col)
    each = read.select("key", F.explode("mentions").alias("m")).select("key", "m.*")
    patterns, scores = score(each.select("inst", "label", "shape", "contexts"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    best = scores.where(F.col("score") >= ACCEPT).groupBy("inst").agg(F.max(F.struct("score", (-order).alias("minus"), "kind")).alias("best"))
    unknown = each.where("label IS NULL").select("key", "start", "end", "inst")
    named = unknown.join(best, "inst").select("key", "start", "end", F.col("best.kind").alias("kind"))
    span = F.struct("start", order.alias("ord"), "end", "kind", F.lit("context").alias("by"))
    added = materialize(named.groupBy("key").agg(F.collect_list(span).alias("more")), "pii-added")
    n_bytes = added.agg(F.sum(F.size("more") * 64 + 64)).first()[0] or 0
    held = F.broadcast(added) if n_bytes <= BROADCAST_BYTES else added
    more = F.filter(
        F.coalesce("more", F.array().cast(SPANS)),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    spans = read.join(held, "key", "left").select(F.col("id").alias(id_col), F.array_sort(F.concat("base", more)).alias("spans"))
    return Extraction(spans, patterns)
