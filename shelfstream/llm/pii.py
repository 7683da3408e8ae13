"""Personal data: pattern generators, boosted trees over format and context, and a calibrated threshold, all in SQL expressions.

Four base patterns with their checks (``BASE``) always count. High-recall generators propose further, overlapping spans
(``WIDE``). Boosted trees are fitted to all proposals, counted by kind, features and label: one that is a valid base match, or a token assigned to a
name like password, is private. Others are unlabelled: those near a hint, beside a base match, or in a format like that of
private ones may be either and teach nothing; the rest count as not private. Features see neither the assignment nor the signs
that base patterns need (a plus; an at-sign or dot that may be spelled out or stand apart), and phones are learnt from without
their country code and with plain dashes, too, so what is learnt holds for wider forms. Each kind's threshold is the lowest at which held-out
proposals, private and not in equal weight, are private nine times in ten. Trees become nested CASE expressions, so every
text is read, matched and scored in one scan without a shuffle.

A null text is empty and has no spans; a null doc_id stays null; repeated rows are treated each; without enough proposals of
both kinds only base spans come out; an empty table gives no rows; other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

# The base patterns. Possessive repeats and look-behinds change no match; they keep long runs of one kind of
# character in linear time and long matches off the call stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "secret")

# Generators: an address with signs spelled out or apart, a run of digit groups, a long mixed token with its padding.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)++",
    "phone": r"[+(]?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)*+",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{12,}+={0,2}+",
}
#: Digits that a number run needs to be proposed, and from which, if its check digit is right, it is proposed as a card.
RUN_DIGITS, CARD_DIGITS = 7, 12
ASSIGNED = r"(?i)(?:password|passwd|pwd|token|secret|api_?key|key)\W{1,4}$"
HINTS = r"(?i)(?:mail|contact|tel|phone|call|fax|card|visa|iban|account|login|user|host|server|address)\W{0,4}\w*\W*$"
CONTEXT = 24
BLOCK = 128
LEAST_ROWS = 8
PRECISION = 0.9
FEATURES = (
    "email", "secret", "size", "digits", "letters", "spaces", "dots", "dashes", "parens", "groups", "luhn", "octets", "upper", "hint", "glued", "quoted", "named", "dated",
)


def _before_each(lengths: Column) -> Column:
    """Sums of all earlier values, for each value. Blocks keep the growing arrays short, so that this stays near linear."""
    grown = lambda values: F.aggregate(
        values,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"],
    )
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)
    last = F.greatest(F.lit(0), F.ceil(F.size(lengths) / BLOCK).cast("int") - 1)
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lengths, i * BLOCK + 1, BLOCK))
    starts = grown(F.transform(blocks, total))
    return F.flatten(F.zip_with(blocks, starts, lambda block, start: F.transform(grown(block), lambda x: x + start)))


def with_matches(rows: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with a column for each name: matches of its pattern in column ``text`` where its condition holds, from left to
    right, as array of (start, end, value, before, after) with places in code points.

    Each step is a projection of its own, and lambdas see columns only: an expression inside one is computed for each element.
    """
    none = F.array().cast("array<string>")
    for suffix, made in (
        ("found", lambda k, p, has: F.when(has, F.regexp_extract_all("text", F.lit(p), 0)).otherwise(none)),
        ("gaps", lambda k, p, has: F.when(F.size(f"{k}_found") > 0, F.split("text", p, -1)).otherwise(none)),
        ("lengths", lambda k, p, has: F.zip_with(f"{k}_gaps", f"{k}_found", lambda g, v: (F.length(g) + F.coalesce(F.length(v), F.lit(0))).cast("long"))),
        ("starts", lambda k, p, has: _before_each(F.col(f"{k}_lengths"))),
        ("after", lambda k, p, has: F.transform(F.slice(f"{k}_gaps", 2, F.greatest(F.lit(0), F.size(f"{k}_gaps") - 1)), lambda g: F.left(g, F.lit(1)))),
    ):
        rows = rows.withColumns({f"{k}_{suffix}": made(k, p, has) for k, (p, has) in patterns.items()})

    def described(k: str) -> Column:
        parts = F.arrays_zip(f"{k}_found", f"{k}_gaps", f"{k}_starts", f"{k}_after")
        whole = F.slice(parts, 1, F.size(f"{k}_found"))  # the last gap has no match
        return F.transform(
            whole,
            lambda m: F.struct(
                (m[f"{k}_starts"] + F.length(m[f"{k}_gaps"])).alias("start"),
                (m[f"{k}_starts"] + F.length(m[f"{k}_gaps"]) + F.length(m[f"{k}_found"])).alias("end"),
                m[f"{k}_found"].alias("value"),
                F.right(m[f"{k}_gaps"], F.lit(CONTEXT)).alias("before"),
                m[f"{k}_after"].alias("after"),
            ),
        )

    made = rows.withColumns({k: described(k) for k in patterns})
    return made.drop(*(f"{k}_{suffix}" for k in patterns for suffix in ("found", "gaps", "lengths", "starts", "after")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).try_cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return acc + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _card(value: Column) -> Column:
    return F.when(F.length(_digits(value)).between(12, 19), _luhn(_digits(value))).otherwise(False)


def _octets(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


#: Kind: (pattern, a text without which there is no match, check of a match).
BASE = {
    "email": (EMAIL, "@", lambda v: F.lit(True)),
    "ip": (IP, ".", _octets),
    "card": (CARD, None, _card),
    "phone": (PHONE, "+", lambda v: F.length(_digits(v)).between(9, 15)),
}


@dataclass(frozen=True)
class Trees:
    """Boosted trees as (weight, tree); a tree is a number or (feature, bound, tree if at most, tree if more). ``thresholds`` has
    (order of a kind, threshold); other kinds add nothing."""

    trees: tuple = ()
    thresholds: tuple = ()

    def probability(self, features: Column) -> Column:
        def grown(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, bound, low, high = tree
            return F.when(features[name] <= bound, grown(low)).otherwise(grown(high))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + weight * grown(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def chosen(self, features: Column) -> Column:
        bound = F.lit(None).cast("double")
        for order, threshold in self.thresholds:
            bound = F.when(features["order"] == order, F.lit(threshold)).otherwise(bound)
        return F.coalesce(self.probability(features) >= bound, F.lit(False))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), m["end"].alias("end")))


def _of_value(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda m: check(m["value"])


def _features(m: Column, kind: Column) -> Column:
    value, digits = m["value"], _digits(m["value"])
    n = lambda pattern: F.length(F.regexp_replace(value, pattern, ""))
    # Counts that say nothing about a kind are zero for it, so that no tree asks an address for digits or a number for length.
    email, secret = kind == KINDS.index("email"), kind == KINDS.index("secret")
    columns = {
        "email": email.cast("int"),
        "secret": secret.cast("int"),
        "size": F.when(secret, F.length(value)).otherwise(0),
        "digits": F.when(email, 0).otherwise(F.length(digits)),
        "letters": n("[^A-Za-z]"),
        "spaces": n("[^ ]"),
        "dots": n(r"[^.]"),
        "dashes": n("[^-]"),
        "parens": n("[^()]"),
        "groups": F.when(email, 0).otherwise(F.size(F.split(value, "[^0-9]+", -1))),
        "luhn": F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False).cast("int"),
        "octets": F.when(value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), _octets(value)).otherwise(False).cast("int"),
        "upper": n("[^A-Z]"),
        "hint": m["before"].rlike(HINTS).cast("int"),
        "glued": (m["before"].rlike(r"\w$") | m["after"].rlike(r"^\w")).cast("int"),
        "quoted": m["after"].rlike("^[\"']").cast("int"),
        "named": value.rlike(r"\.[A-Za-z]{2,}$").cast("int"),
        "dated": value.rlike(r"^(19|20)[0-9]{2}[-. ]?(0[1-9]|1[0-2])[-. ]?[0-3][0-9]").cast("int"),
    }
    assigned = kind.eqNullSafe(KINDS.index("secret")) & m["before"].rlike(ASSIGNED)
    place = kind.alias("order"), m["start"].alias("start"), m["end"].alias("end"), assigned.alias("assigned")
    return F.struct(*place, *(columns[c].cast("double").alias(c) for c in FEATURES))


def _without_signs(kind: str) -> Callable[[Column], Column]:
    """A generated match whose value has plain signs for those spelled out or apart, and no plus."""

    def value(v: Column) -> Column:
        if kind == "email":
            return F.regexp_replace(F.regexp_replace(v, r" ?(@|[(\[]at[)\]]) ?", "@"), r" ?[(\[]dot[)\]] ?", ".")
        return F.regexp_replace(v, r"^\+", "") if kind == "phone" else v

    return lambda m: _with_value(m, value(m["value"]))


def _with_value(m: Column, value: Column) -> Column:
    return F.struct(*(value.alias(c) if c == "value" else m[c].alias(c) for c in ("start", "end", "value", "before", "after")))


def _described(kind: str) -> Callable[[Column], Column]:
    """Order of the kind and features of a generated match."""

    def order(m: Column) -> Column:
        if kind != "phone":
            return F.lit(KINDS.index(kind))
        digits = _digits(m["value"])
        long = F.when(F.length(digits) >= CARD_DIGITS, _luhn(digits)).otherwise(False)
        return F.when(long, F.lit(KINDS.index("card"))).otherwise(F.lit(KINDS.index("phone")))

    return lambda m: _features(m, order(m))


def _proposed(searched: DataFrame, national: bool = False) -> DataFrame:
    """``searched`` with ``proposals``: generated spans with features; ``known`` tells those that meet a base span, ``covered`` those
    that lie in one, ``exact`` those that are one of their kind. With ``national``, phones with a plus come twice more, with the
    features they have without their country code, as written and with dashes between their groups."""
    addressed = F.contains("text", F.lit("@")) | F.col("text").rlike(r"[(\[]at[)\]]")
    found = with_matches(searched, {f"wide_{k}": (p, addressed if k == "email" else F.col("numeric")) for k, p in WIDE.items()})
    enough = F.filter("wide_phone", lambda m: F.length(_digits(m["value"])) >= RUN_DIGITS)
    found = found.withColumn("wide_phone", enough)
    if national:
        shorter = F.transform(
            F.filter("wide_phone", lambda m: m["value"].rlike(r"^\+[0-9]{1,3}[\x20.(-]")),
            lambda m: _with_value(m, F.regexp_replace(m["value"], r"^\+[0-9]{1,3}[\x20.-]*", "")),
        )
        found = found.withColumn("wide_national", shorter)
        dashed = F.transform("wide_national", lambda m: _with_value(m, F.regexp_replace(F.regexp_replace(m["value"], "[()]", ""), r"[\x20.]+", "-")))
        found = found.withColumn("wide_phone", F.concat("wide_phone", "wide_national", dashed)).drop("wide_national")
    found = found.withColumns({f"wide_{k}": F.transform(f"wide_{k}", _without_signs(k)) for k in WIDE})
    found = found.withColumn("spans_wide", F.concat(*(F.transform(f"wide_{k}", _described(k)) for k in WIDE)))
    met = lambda p, base: F.exists(base, lambda b: (b["start"] < p["end"]) & (b["end"] > p["start"]))
    inside = lambda p, base: F.exists(base, lambda b: (b["start"] <= p["start"]) & (b["end"] >= p["end"]))
    numbers = [KINDS.index("card"), KINDS.index("phone")]
    kin = lambda p, b: (p["order"] == b["order"]) | p["order"].isin(numbers) & b["order"].isin(numbers)
    same = lambda p, base: F.exists(base, lambda b: (b["start"] == p["start"]) & (b["end"] == p["end"]) & kin(p, b))
    # Each span gets the base spans beside it: named inside the lambda, they could be computed anew for each.
    paired = F.arrays_zip("spans_wide", F.array_repeat("base", F.size("spans_wide")).alias("bases"))
    found = found.withColumn(
        "proposals",
        F.transform(
            paired,
            lambda z: F.struct(z["spans_wide"].alias("span"), *(f(z["spans_wide"], z["bases"]).alias(n) for n, f in (("known", met), ("covered", inside), ("exact", same)))),
        ),
    )
    return found.drop("spans_wide", *(f"wide_{k}" for k in WIDE))


def _searched(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in ``row``, the text without null, and what the base patterns find."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("text", F.coalesce("row.text", F.lit(""))).withColumn("numeric", F.col("text").rlike("[0-9]"))
    patterns = {}
    for kind, (pattern, sign, _) in BASE.items():
        has = F.contains("text", F.lit(sign)) if sign else F.lit(True)
        patterns[kind] = pattern, has if kind == "email" else has & F.col("numeric")
    found = with_matches(rows, patterns)
    found = found.withColumns({kind: _spans(kind, F.filter(kind, _of_value(check))) for kind, (_, _, check) in BASE.items()})
    return found.withColumn("base", F.array_sort(F.concat(*BASE)))


def train(docs: DataFrame) -> Trees:
    """Trees and thresholds from all proposals; equal ones (kind, features, label) are one row that weighs their number. A hash of
    document and place keeps a quarter of them for the thresholds."""
    # A plain explode() would have its size test pushed below all steps, with their expressions inlined and computed again.
    proposals = _proposed(_searched(docs), national=True).select(F.col("row.doc_id").alias("doc_id"), F.explode_outer("proposals").alias("p")).where("p is not null")
    private = F.col("p.exact") | F.col("p.span.assigned")
    flat = proposals.where(F.col("p.exact") | ~F.col("p.covered") & (private | ~(F.col("p.known") | _doubtful("p.span")))).select(
        (F.pmod(F.xxhash64("doc_id", "p.span.start", "p.span.order"), F.lit(4)) == 0).alias("held"),
        F.col("p.span.order").alias("order"),
        private.cast("double").alias("label"),
        *(F.col(f"p.span.{c}").alias(c) for c in FEATURES),
    )
    different = ["held", "order", "label", *FEATURES]
    # Sorted, so that a rerun sums in the same order.
    counted = settled(flat.groupBy(*different).agg(F.count(F.lit(1)).cast("double").alias("n")).sortWithinPartitions(*different))
    counts = dict(counted.groupBy("label").agg(F.sum("n")).collect())
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_ROWS:
        return Trees()
    fit = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(counted.where("not held")).select("label", "n", "features")
    model = GBTClassifier(maxIter=8, maxDepth=3, maxBins=32, stepSize=0.3, seed=7, weightCol="n").fit(fit)
    trees = tuple((float(w), _parsed(t.toDebugString)) for w, t in zip(model.treeWeights, model.trees))
    scored = counted.where("held").select("order", "label", "n", Trees(trees).probability(F.struct(*FEATURES)).alias("score"))
    # One row per kind and distinct score of the trees.
    tally = scored.groupBy("order", "score").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum((1 - F.col("label")) * F.col("n")).alias("bad"))
    by_kind: dict[int, list] = {}
    for r in tally.orderBy(F.desc("score")).collect():
        by_kind.setdefault(r["order"], []).append((r["score"], r["good"], r["bad"]))
    return Trees(trees, tuple((order, t) for order, found in sorted(by_kind.items()) if (t := _threshold(found)) is not None))


def _threshold(found: list[tuple[float, float, float]]) -> float | None:
    """Midway between the lowest score of a private proposal at which private ones, both sides in equal weight, are ``PRECISION``
    of those at or above it, and the next score of another; ``found`` has (score, private ones, others) by falling score."""
    all_good, all_bad = sum(g for _, g, _ in found), sum(b for _, _, b in found)
    lowest, below, good, bad = None, 0.0, 0.0, 0.0
    for score, g, b in found:
        good, bad = good + g, bad + b
        right, wrong = good / all_good if all_good else 0.0, bad / all_bad if all_bad else 0.0
        if g and right >= PRECISION * (right + wrong):
            lowest, below = float(score), 0.0
        elif b and not below:
            below = float(score)
    return None if lowest is None else (lowest + below) / 2


def _doubtful(span: str) -> Column:
    """Whether an unlabelled proposal may be private: near a hint, or in the format of base matches and of keys."""
    f = lambda name: F.col(f"{span}.{name}")
    address = (f("email") > 0) & (f("named") > 0)
    number = (f("email") + f("secret") == 0) & f("digits").between(9, 15) & (f("dated") == 0) & (f("groups").between(3, 6) | (f("parens") > 0))
    key = (f("secret") > 0) & (f("size") >= 16) & (f("dashes") == 0) & (4 * f("digits") >= f("size"))
    return (f("hint") > 0) | address | number | key


def _parsed(description: str):
    """A tree from the lines ``If (feature i <= x)``, its branch, ``Else (...)``, its branch, and ``Predict: y``."""
    lines = iter([line.strip() for line in description.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def branch():
        line = next(lines)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = branch()
        next(lines)
        return FEATURES[int(feature)], float(bound), low, branch()

    return branch()


def find(docs: DataFrame, trees: Trees) -> DataFrame:
    """``row`` (the columns of ``docs``), the text, base spans by kind and in ``base``, and all spans in ``spans``."""
    searched = _searched(docs)
    if not trees.trees:
        return searched.withColumn("spans", F.col("base"))
    chosen = F.filter("proposals", lambda p: ~p["covered"] & trees.chosen(p["span"]))
    added = F.transform(chosen, lambda p: F.struct(p["span"]["start"].alias("start"), p["span"]["order"].alias("order"), p["span"]["end"].alias("end")))
    return _proposed(searched).withColumn("spans", F.array_sort(F.concat("base", added))).drop("proposals")


def listed(spans: str) -> Column:
    """kind:start:end of each span, by start, then kind; joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    said = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(said, ",")


def redact(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with each span's text replaced by its kind in brackets; overlapping spans are replaced once, as the first's kind."""
    kinds = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("pieces"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.array(F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.get(kinds, s["order"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["pieces"], piece)).otherwise(acc["pieces"]).alias("pieces")
        )

    done = F.aggregate(
        "spans",
        start,
        step,
        lambda acc: F.concat(F.array_join(acc["pieces"], ""), F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))),
    )
    found = find(docs, trees).withColumn("redacted", done)
    changed = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}  # a character count follows the text
    some = F.size("spans") > 0
    return found.select(
        *(F.when(some, changed[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns)
    )
