"""Personal data in texts: generators propose spans, boosted trees score them, thresholds choose.

Spans that match a base pattern and pass its check always count. High-recall generators propose
more: addresses written out, numbers with unusual separators or without a plus sign. What is a hit
there depends on format and context, which trees learn from the corpus itself: base spans, also
with their marker hidden, stand for personal data; proposals that fail a check, and twins of base
spans spoilt in a stated way, stand against it. All of it is Spark functions and aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ready
from starmill.session import stage

KINDS = ["email", "ip", "card", "phone"]

#: The base patterns, leftmost and not overlapping. Written with possessive
#: repeats and with bounds to the left, which match the same but never go back over a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

WHOLE_EMAIL = r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"

#: Texts without a match of these have no match of the base pattern.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}

_AT = r"(?:\x20?[@＠]\x20?|\x20?[\[({<]\x20?(?:at|AT)\x20?[\])}>]\x20?)"
_DOT = r"(?:\.|\x20?[\[({<]\x20?(?:dot|DOT)\x20?[\])}>]\x20?)"
_HOST = r"[\p{L}\p{N}-]{1,63}+"
_BY = r"[\x20.\xa0/_–-]"
_LEFT, _RIGHT = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"

#: What is proposed beside base spans, and what a text needs to have any of it.
WIDE = {
    "email": [
        rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]{{1,64}}+{_AT}{_HOST}(?:{_DOT}{_HOST}){{1,8}}+",
        rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]{{1,64}}+\x20(?:at|AT)\x20{_HOST}"
        rf"(?:\x20(?:dot|DOT)\x20{_HOST}){{1,8}}+",
    ],
    "ip": [
        rf"{_LEFT}[0-9]{{1,3}}(?:(?:\x20?[\[({{]?(?:\.|dot)[\])}}]?\x20?)[0-9]{{1,3}}){{3}}{_RIGHT}",
        r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    ],
    "card": [
        rf"{_LEFT}[0-9]{{4}}({_BY}{{1,2}}+)[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{2,7}}{_RIGHT}"
        rf"|{_LEFT}[0-9]{{4}}({_BY}{{1,2}}+)[0-9]{{6}}\2[0-9]{{4,5}}{_RIGHT}|{_LEFT}[0-9]{{13}}{_RIGHT}",
    ],
    "phone": [
        rf"(?<![\p{{L}}\p{{N}}+.,-])(?:\([0-9]{{1,5}}\)|[0-9]{{2,5}})"
        rf"(?:[\x20./-]{{1,2}}+\(?[0-9]{{2,8}}\)?){{1,5}}+(?![\p{{L}}\p{{N}},.-]*[0-9]){_RIGHT}",
    ],
}
WIDE_NEEDS = {
    "email": [rf"[@＠]|[\[({{<]\x20?(?:at|AT)\x20?[\])}}>]", r"\x20(?:at|AT)\x20[\p{L}\p{N}-]++\x20(?:dot|DOT)\x20"],
    "ip": [r"[0-9]\x20?[\[({]?(?:\.|dot)[\])}]?\x20?[0-9]", r"[0-9A-Fa-f]:[0-9A-Fa-f:]"],
    "card": [r"[0-9]{4}[\x20.\xa0/_–-]{1,2}[0-9]{4}|[0-9]{13}"],
    "phone": [r"[0-9)][\x20./-]{1,2}\(?[0-9]{2}"],
}
#: Words before a span that speak for its kind, and for something else.
OWN = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|kontakt|correo|courriel|write to)\b",
    "ip": r"(?i)\b(?:ip|host|address|server|login|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|karte|carte|tarjeta|credit)\b",
    "phone": r"(?i)\b(?:tel|phone|telephone|telefon|call|fax|mobile|cell|mobil|whatsapp|dial)\b",
}
FOREIGN = (
    r"(?i)\b(?:version|v|release|order|invoice|isbn|issn|doi|page|pages|section|chapter|figure"
    r"|price|total|date|year|build|revision|article|no|nr)\b[.:#\x20]*$"
)
#: Octets up to 255, with any number of zeros before.
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\D+0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
BEFORE, AFTER = 24, 4

#: The values of each feature; their product bounds the cells that the trees are grown on.
FEATURES = {
    "kind": 4,
    "marker": 2,
    "valid": 2,
    "digits": 8,
    "groups": 5,
    "sep": 5,
    "before": 4,
    "after": 3,
    "word": 3,
    "lead": 3,
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- spans -----------------------------------------------------------------------------------


def running_sum(sizes: Column) -> Column:
    """Sums up to each entry, by doubling strides, so a long array takes n log n steps."""
    strides = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)))).cast("int"))

    def step(sums: Column, k: Column) -> Column:
        stride = F.pow(F.lit(2), k).cast("int")
        return F.transform(
            sums, lambda x, i: x + F.when(i >= stride, F.get(sums, i - stride)).otherwise(F.lit(0))
        )

    return F.aggregate(strides, sizes, step)


def spans(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches in a text, leftmost first: structs (start, end, hit, before, after), places in
    code points, the end exclusive, with some of the text since the match before and up to the
    next one. A text without a match of ``needs`` is not looked at."""

    def placed(found: Column) -> Column:
        sizes = F.zip_with(
            F.slice(found["gaps"], F.lit(1), F.size(found["hits"])),
            found["hits"],
            lambda gap, hit: F.char_length(gap) + F.char_length(hit),
        )
        return let(
            running_sum(sizes),
            lambda ends: F.transform(
                found["hits"],
                lambda hit, i: F.struct(
                    (F.get(ends, i) - F.char_length(hit)).alias("start"),
                    F.get(ends, i).alias("end"),
                    hit.alias("hit"),
                    F.right(F.get(found["gaps"], i), F.lit(BEFORE)).alias("before"),
                    F.substring(F.get(found["gaps"], i + 1), 1, AFTER).alias("after"),
                ),
            ),
        )

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    none = F.array().cast(
        "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
    )
    made = let(found, placed)
    if needs is None:
        return made
    present = F.contains(text, F.lit("@")) if needs == "@" else F.rlike(text, F.lit(needs))
    return F.when(present, made).otherwise(none)


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, F.lit(r"[^0-9]"), F.lit(""))


def passes(kind: str, hit: Column) -> Column:
    """The check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(hit, F.lit(OCTETS))
    digits = digits_of(hit)
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.char_length(digits).between(10, 15)


def blanked(text: Column, kind: str) -> Column:
    """The text with stars in place of the base spans of a kind, as many as they have characters."""

    def joined(found: Column) -> Column:
        hits = F.array_append(found["hits"], F.lit(""))
        parts = F.zip_with(
            found["gaps"],
            hits,
            lambda gap, hit: F.concat(
                gap, F.when(passes(kind, hit), F.repeat(F.lit("*"), F.char_length(hit))).otherwise(hit)
            ),
        )
        return F.array_join(parts, "")

    found = F.struct(
        F.regexp_extract_all(text, F.lit(BASE[kind]), F.lit(0)).alias("hits"),
        F.split(text, BASE[kind], -1).alias("gaps"),
    )
    return F.when(F.rlike(text, F.lit(NEEDS[kind])), let(found, joined)).otherwise(text)


# -- features --------------------------------------------------------------------------------


def valid(kind: str, hit: Column) -> Column:
    """Whether a proposal could be what its kind says, however it is written."""
    if kind == "email":
        return F.rlike(hit, F.lit(r"(?:\p{L}{2,}|xn--[\p{L}\p{N}-]+)$"))
    if kind == "ip":
        long_form = F.rlike(hit, F.lit(r"^[^:]*:[^:]*:")) & (F.char_length(digits_of(hit)) >= 2)
        return long_form | F.rlike(hit, F.lit(OCTETS))
    if kind == "card":
        digits = digits_of(hit)
        return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.char_length(digits_of(hit)).between(10, 15)


MARKER = {
    "email": r"^[^\x20\[({<]+@[^\x20\[({<]+$",
    "ip": r"^[0-9.]+$",
    "card": r"^[0-9]+$",
    "phone": r"^\+",
}


def code(*cases: tuple[Column, int], default: int) -> Column:
    out = F.lit(default)
    for condition, value in reversed(cases):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def features(kind: str, s: Column) -> Column:
    """Format and context of a span as small numbers, each below its entry of FEATURES."""
    hit, before, after = s["hit"], s["before"], s["after"]
    n = F.char_length(digits_of(hit))
    groups = F.size(F.regexp_extract_all(hit, F.lit(r"[0-9]+"), F.lit(0)))
    between = F.regexp_replace(hit, F.lit(r"[\p{L}\p{N}+@＠]"), F.lit(""))
    made = {
        "kind": F.lit(KINDS.index(kind)),
        "marker": F.rlike(hit, F.lit(MARKER[kind])).cast("int"),
        "valid": valid(kind, hit).cast("int"),
        "digits": code((n == 0, 0), (n <= 6, 1), (n <= 9, 2), (n == 10, 3), (n == 11, 4),
                       (n <= 13, 5), (n <= 15, 6), default=7),
        "groups": F.least(groups, F.lit(4)),
        "sep": code((between == "", 0), (F.rlike(between, F.lit(r"^[\x20\xa0]+$")), 1),
                    (F.rlike(between, F.lit("^-+$")), 2), (F.rlike(between, F.lit(r"^\.+$")), 3),
                    default=4),
        "before": code((F.rlike(before, F.lit(r"(?:^|\s)$")), 0),
                       (F.rlike(before, F.lit(r"[\p{L}\p{N}]$")), 1),
                       (F.rlike(before, F.lit(r"[:(\[<\"'=,;]$")), 2), default=3),
        "after": code((F.rlike(after, F.lit(r"^(?:$|[\s.,;:!?)\]>\"'])")), 0),
                      (F.rlike(after, F.lit(r"^[\p{L}\p{N}]")), 1), default=2),
        "word": code((F.rlike(before, F.lit(FOREIGN)), 0), (F.rlike(before, F.lit(OWN[kind])), 2),
                     default=1),
        "lead": code((F.startswith(hit, F.lit("(")), 1), (F.startswith(hit, F.lit("0")), 2),
                     default=0),
    }
    return F.struct(*[made[name].cast("int").alias(name) for name in FEATURES])


def described(kind: str, found: Column, base: bool) -> Column:
    """Spans with their kind, features, and whether a base match passed its check."""
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(base).alias("of_base"),
            (passes(kind, s["hit"]) if base else F.lit(False)).alias("passed"),
            (F.pmod(F.xxhash64(s["hit"]), F.lit(5)) == 0).alias("held"),
            features(kind, s).alias("features"),
        ),
    )


def proposals(docs: DataFrame) -> DataFrame:
    """Per document all base matches and wide proposals, as an array of described spans.

    Numbers are proposed where no base span lies; so are addresses, unless one is a base span.
    """
    text = F.col("text")
    found = docs.withColumn("rest", text)
    for k in KINDS[1:]:
        found = found.withColumn("rest", blanked(F.col("rest"), k))
    made = [described(k, spans(text, BASE[k], NEEDS[k]), True) for k in KINDS]
    for k in KINDS:
        source = text if k == "email" else F.col("rest")
        for pattern, needs in zip(WIDE[k], WIDE_NEEDS[k], strict=True):
            wide = spans(source, pattern, needs)
            if k == "email":
                wide = F.filter(wide, lambda s: ~F.rlike(s["hit"], F.lit(WHOLE_EMAIL)))
            made.append(described(k, wide, False))
    return found.withColumn("spans", F.concat(*made)).drop("rest")


# -- boosted trees ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Split:
    """Values of a feature up to ``limit`` go left."""

    feature: str
    limit: int
    left: Split | float
    right: Split | float


Tree = Split | float


def value_of(tree: Tree, feature: Callable[[str], Column]) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    goes_left = feature(tree.feature) <= tree.limit
    return F.when(goes_left, value_of(tree.left, feature)).otherwise(value_of(tree.right, feature))


def probability(trees: list[Tree], feature: Callable[[str], Column]) -> Column:
    total = reduce(add, [value_of(t, feature) for t in trees], F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def doubtful(f: Callable[[str], Column]) -> Column:
    """Without their marker, spans after a word for something else are no personal data, nor are
    plain runs of digits for a phone number without a word for it or a leading 0 or bracket."""
    plain = (f("kind") == KINDS.index("phone")) & (f("lead") == 0) & (f("word") != 2)
    plain = plain & ((f("groups") <= 1) | (f("sep") <= 1))
    return (f("marker") == 0) & ((f("word") == 0) | plain)


#: How base spans are changed to twins: the features that are set.
TWINS = [
    {},
    {"marker": 0},
    {"valid": 0},
    {"valid": 0, "marker": 0},
    {"marker": 0, "word": 0},
    {"marker": 0, "word": 2},
    {"marker": 0, "lead": 1},
    {"marker": 0, "lead": 0, "sep": 1},
    {"marker": 0, "lead": 0, "sep": 1, "word": 2},
    {"marker": 0, "lead": 0, "sep": 2},
    {"marker": 0, "lead": 0, "sep": 0, "groups": 1},
]


def cells(found: DataFrame) -> DataFrame:
    """Examples by their features, counted: ``held, label, n``, and ``weight``, of which each
    kind and label has 1 in all. At most two rows per label and combination of features.

    Base spans and their twins are examples, and so is all that fails its check. Other proposals
    have no label.
    """
    rows = found.select(F.explode("spans").alias("s")).select("s.*")

    def twin(changes: dict[str, int]) -> Column:
        value = {
            name: F.lit(changes[name]) if name in changes else F.col(f"features.{name}")
            for name in FEATURES
        }
        label = (value["valid"] == 1) & ~doubtful(value.__getitem__) if changes else F.lit(True)
        return F.struct(label.cast("int").alias("label"), *[c.alias(n) for n, c in value.items()])

    against = F.struct(F.lit(0).alias("label"), *[F.col(f"features.{n}") for n in FEATURES])
    examples = (
        F.when(F.col("passed"), F.array(*[twin(c) for c in TWINS]))
        .when(F.col("of_base") | (F.col("features.valid") == 0), F.array(against))
        .otherwise(F.array().cast(EXAMPLES))
    )
    counted = (
        rows.select("held", F.inline(examples))
        .groupBy("held", "label", *FEATURES)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy("held", "kind", "label").agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(totals), ["held", "kind", "label"]).select(
        "held", "label", *FEATURES, (F.col("n") / F.col("total")).alias("weight")
    )


EXAMPLES = "array<struct<label:int," + ",".join(f"{n}:int" for n in FEATURES) + ">>"


def grow(examples: DataFrame, trees: list[Tree], depth: int, rate: float, ridge: float) -> Tree:
    """One more tree on the gradient of the log loss. Each level is one aggregate over the cells,
    of at most one row per node, feature and value."""
    p = probability(trees, F.col)
    sums = examples.select(
        *FEATURES,
        (F.col("weight") * (F.col("label") - p)).alias("g"),
        (F.col("weight") * p * (1 - p)).alias("h"),
    )
    names = list(FEATURES)
    entries = F.array(
        *[F.struct(F.lit(i).alias("feature"), F.col(n).alias("at")) for i, n in enumerate(names)]
    )
    nodes: dict[int, tuple[str, int] | float] = {}
    node = F.lit(1)
    for level in range(depth):
        found = (
            sums.select(node.alias("node"), "g", "h", F.inline(entries))
            .groupBy("node", "feature", "at")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            .collect()
        )
        by_node: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
        for row in found:
            by_feature = by_node.setdefault(row.node, {})
            by_feature.setdefault(row.feature, {})[row.at] = (row.g, row.h)
        for n in sorted(by_node):
            split, left, right = best_split(by_node[n], ridge)
            if split is None:
                nodes[n] = rate * left
                continue
            nodes[n] = (names[split[0]], split[1])
            if level == depth - 1:
                nodes[2 * n], nodes[2 * n + 1] = rate * left, rate * right
        moved = F.lit(0)
        for n in sorted(by_node):
            if isinstance(nodes[n], tuple):
                name, limit = nodes[n]
                below = F.when(F.col(name) <= limit, F.lit(2 * n)).otherwise(F.lit(2 * n + 1))
                moved = F.when(node == n, below).otherwise(moved)
        node = moved
        sums = sums.select(*FEATURES, "g", "h", node.alias("next")).where("next > 0")
        node = F.col("next")

    def made(n: int) -> Tree:
        if isinstance(nodes.get(n, 0.0), tuple):
            name, limit = nodes[n]
            return Split(name, limit, made(2 * n), made(2 * n + 1))
        return float(nodes.get(n, 0.0))

    return made(1)


def best_split(by_feature: dict[int, dict[int, tuple[float, float]]], ridge: float):
    """The split (feature, limit) with the greatest gain and the values of both sides; no split
    and the value of the node if nothing gains. Equal gains go to the first feature."""

    def weight(g: float, h: float) -> float:
        return g / (h + ridge)

    some = next(iter(by_feature.values())).values()
    all_g, all_h = (math.fsum(x[i] for x in some) for i in (0, 1))
    best, gain = None, 1e-6
    for feature in sorted(by_feature):
        g = h = 0.0
        for at in sorted(by_feature[feature])[:-1]:
            g, h = g + by_feature[feature][at][0], h + by_feature[feature][at][1]
            rest_g, rest_h = all_g - g, all_h - h
            more = g * weight(g, h) + rest_g * weight(rest_g, rest_h) - all_g * weight(all_g, all_h)
            if more > gain + 1e-12:
                gain = more
                best = (feature, at), weight(g, h), weight(rest_g, rest_h)
    return best or (None, weight(all_g, all_h), 0.0)


def fit(examples: DataFrame, rounds: int, depth: int, rate: float, ridge: float) -> list[Tree]:
    """Boosted trees; stops early when a tree is a single leaf that changes nothing."""
    trees: list[Tree] = []
    for _ in range(rounds):
        tree = grow(examples, trees, depth, rate, ridge)
        if not isinstance(tree, Split):
            break
        trees.append(tree)
    return trees


def thresholds(held: DataFrame, trees: list[Tree], precision: float) -> dict[str, float]:
    """For each kind the least probability, 0.5 or more, from which on held-out examples are right
    with the given precision; over 1, so nothing is added, where no example shows it."""
    steps = 1000
    bins = held.select(
        "kind",
        F.floor(probability(trees, F.col) * steps).cast("int").alias("bin"),
        (F.col("weight") * F.col("label")).alias("right"),
        (F.col("weight") * (1 - F.col("label"))).alias("wrong"),
    )
    rows = bins.groupBy("kind", "bin").agg(F.sum("right"), F.sum("wrong")).collect()
    out = dict.fromkeys(KINDS, 2.0)
    for i, kind in enumerate(KINDS):
        right = wrong = 0.0
        for _, at, yes, no in sorted((r for r in rows if r[0] == i), key=lambda r: -r[1]):
            right, wrong = right + yes, wrong + no
            if at < steps // 2 or right < precision * (right + wrong):
                break
            out[kind] = at / steps
    return out


# -- operator --------------------------------------------------------------------------------

SPAN = "array<struct<start:int,end:int,kind:int,base:boolean,score:double>>"


def find_private(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 10,
    depth: int = 3,
    rate: float = 0.5,
    ridge: float = 0.01,
    precision: float = 0.99,
    keep_text: bool = False,
) -> DataFrame:
    """Spans of personal data per document: ``doc_id, spans``, and ``text`` on request. A span is
    (start, end, kind, base, score): places in code points, the end exclusive; the kind as its
    place in KINDS; whether it is a base span; its probability. Spans are sorted, none twice;
    those of different kinds may overlap.

    Base spans always count. Proposals count from the threshold of their kind on, which is set on
    a fifth of the examples, by the hash of the span, that the trees have not seen. All spans of
    all texts are examples; the trees are grown on counts per combination of features, of which
    there are at most the product of FEATURES, however large the corpus is.

    Null texts are empty. Empty tables, and tables without any span, give no spans. Null and
    repeated ids are documents of their own; other columns are not read. Every row is worked on
    by itself, so no document, kind or value is a heavy key.
    """
    ready(df.sparkSession)
    docs = df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    found = proposals(docs)
    found = stage(found if keep_text else found.drop("text"), "private-proposals")
    examples = stage(cells(found).coalesce(8), "private-cells")
    trees = fit(examples.where("NOT held"), rounds, depth, rate, ridge)
    limits = thresholds(examples.where("held"), trees, precision)

    def scored(s: Column) -> Column:
        f = s["features"]
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            f["kind"].alias("kind"),
            s["of_base"].alias("base"),
            probability(trees, lambda name: f[name]).alias("score"),
        )

    least = F.array(*[F.lit(limits[k]) for k in KINDS])
    open_spans = F.filter("spans", lambda s: s["passed"] | (~s["of_base"] & (s["features"]["valid"] == 1)))
    chosen = F.filter(
        F.transform(open_spans, scored),
        lambda s: s["base"] | (s["score"] >= F.get(least, s["kind"])),
    )
    return found.withColumn("spans", F.array_sort(F.array_distinct(chosen)).cast(SPAN))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas, in order of start, then kind, then end."""
    ordered = F.array_sort(
        F.array_distinct(
            F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("b"), s["end"].alias("c")))
        )
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["b"]), s["a"], s["c"]))
    return F.array_join(parts, ",")


def digest_private(found: DataFrame) -> DataFrame:
    """Per document ``n_email, n_ip, n_card, n_phone`` of base spans, ``base_sha256`` and all
    ``spans`` as text."""
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(found: DataFrame) -> DataFrame:
    """Texts of ``find_private(keep_text=True)`` with each stretch that spans cover replaced by the
    kind of its first span in brackets: ``doc_id, text``."""

    def step(done: Column, s: Column) -> Column:
        name = F.concat(F.lit("["), F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), F.lit("]"))
        gap = F.substr(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        apart = s["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(done["out"], gap, name)).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(
        "spans", start, step, lambda done: F.concat(done["out"], F.substr(F.col("text"), done["at"] + 1))
    )
    return found.select("doc_id", whole.alias("text"))
