"""Personal data by candidate generation and gradient boosting, in SQL functions only.

High-recall generators propose overlapping spans: the base patterns, valid or not, looser
forms (spelt-out e-mail addresses, national phone numbers, IPv6 addresses, cards with other
separators), and the parts of failing base runs that pass the check themselves (13 to 19
digits of a card run and four parts of a dotted one, from border to border of its groups of
digits, and 9 to 15 leading digits of a phone number).  Base matches are labelled by their checks (Luhn, part and digit ranges).  Other candidates are
labelled where form and context leave no doubt (``_weak``: a spelt-out address in prose is none,
one with bracketed signs is), a few sentences of either kind are added (``SEEDS``), and what
is in doubt isn't learnt from.  Format and context of each
candidate are small whole numbers, so the whole corpus's training set is one table of
counts, bounded by the feature grid.  Boosted trees are fitted on the texts of one hash fold;
on the other each kind's threshold is calibrated: the least score from which on its labelled
candidates that are no base match are precise enough.  Trees are compiled into Spark columns.  Valid base spans always stay; other candidates that
reach their threshold and overlap none of them are added, also where these overlap each other.

Positions: a pattern's matches are fenced with a private-use character, the text is split at
it, and lengths are summed up (in blocks, so that many matches don't cost their square).
Spans that may overlap are fenced copies in front of the place where they start.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
FENCE, STAND_IN = "\ue000", "\ufffd"
BLOCK = 128
CONTEXT = 24            # characters before a candidate that its context features see
ROUNDS, SHRINK, PRECISION = 25, 0.3, 0.98

# The base patterns in Java's possessive form: same leftmost matches, no backtracking.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",     # shorter runs fail the check anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HEX = "[0-9A-Fa-f]"
_NAME, _HOST = rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+", "[A-Za-z0-9-]{1,63}+"
_AT, _DOT = r"[(\[{<] ?at ?[)\]}>]", r"[(\[{<] ?dot ?[)\]}>]"
LOOSE = {
    "email": (rf"(?i:{_NAME}(?: ?{_AT} ?{_HOST}(?: ?(?:\.|{_DOT}) ?{_HOST}| dot {_HOST})++"
              rf"| at {_HOST}(?:\.{_HOST})*+(?:(?: dot | ?{_DOT} ?){_HOST})++"
              rf"|(?!@{_HOST}\.[A-Za-z0-9-]) ?@ ?{_HOST}(?:(?:\.| dot | ?{_DOT} ?){_HOST})++))"),
    "ip": (rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}{{1,4}}+:){{7}}{_HEX}{{1,4}}+|(?!:*+(?:{_HEX}++:++){{7}}{_HEX})"
           rf"(?:{_HEX}{{1,4}}+(?::{_HEX}{{1,4}}+)*+::(?:{_HEX}{{1,4}}+(?::{_HEX}{{1,4}}+)*+)?+|::{_HEX}{{1,4}}+(?::{_HEX}{{1,4}}+)*+))(?![0-9A-Za-z]|:[0-9A-Fa-f:])"),
    "phone": r"(?<![0-9+().-])(?<![0-9+)] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])(?!\.[0-9])",
}
# A text without this has no match (cheap to look for).
_NEEDS = {("base", "email"): "@", ("base", "phone"): "+", ("loose", "ip"): ":"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_GAP = r"[\x20\x09\x0A.,:_/\u00a0\u2010-\u2015-]{1,3}+"
_SEP = r"[\x20().-]*+"
_LEAD = rf"\+(?:[0-9]{_SEP}){{%d}}[0-9]"
_RUN = r"[0-9](?:[\x20-]?+[0-9]){%d}(?![0-9])"
# Where spans may start, and those that start there: they may overlap.  True: only in texts
# with a base match of the kind that fails its check.
PARTS = (
    ("ip", True, "(?<![0-9])", (rf"(?:{_BYTE}\.){{3}}{_BYTE}(?![0-9])",)),
    ("card", True, r"(?<![0-9])(?=[0-9](?:[\x20-]?+[0-9]){12})", tuple(_RUN % (n - 1) for n in range(13, 20))),
    ("card", False, "(?<![0-9])", (rf"[0-9]{{4}}{_GAP}(?:[0-9]{{4}}{_GAP}(?:[0-9]{{4}}{_GAP}){{1,2}}[0-9]{{1,4}}|[0-9]{{6}}{_GAP}[0-9]{{4,5}}|[0-9]{{4}}{_GAP}[0-9]{{5}})(?![0-9])",)),
    # a prefix ends with a group of digits; if none ends after 9 to 15 digits, after any of these
    ("phone", True, r"(?=\+[0-9])", tuple(rf"(?=\+(?:[0-9]{_SEP}){{8}}[0-9]{{8}}|{_LEAD % n}(?![0-9])){_LEAD % n}" for n in range(8, 15))),
)
_WORDS = {"email": "mail|contact", "ip": "ip|host|server|addr", "card": "card|visa|pay|credit", "phone": "phone|tel|call|fax|mobile"}
_OTHERS = {"email": "token|key|secret|hash", "ip": "version|release|chapter|section|std", "card": "serial|token|key|hash|imei|isbn|tracking|checksum",
           "phone": "serial|part|order|ref|version|code|id|isbn|model|invoice"}
FEATURES = ("kind", "digits", "parts", "letters", "before", "hint", "form")
SPAN = "array<struct<kind:int,start:int,stop:int,ok:boolean,digits:int,parts:int,letters:int,before:int,hint:int,form:int>>"
# Lengths that card schemes use after their first digits.
_SCHEMES = r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12}|35[0-9]{14})$"
# (text, whether its candidates are personal data): what the model knows where a corpus shows nothing.
SEEDS = (
    ("mail joe (at) host (dot) org", 1), ("write to ann [at] firm [dot] com", 1), ("reach me: bob (at) site.net", 1), ("contact eve at shop dot com", 1), ("mail jim @ host.org", 1),
    ("we met at noon dot dot", 0), ("look at home dot page now", 0), ("see me at the dot com boom", 0), ("stay at work dot it is late", 0), ("he works at acme.dot.matrix", 0),
    ("call (499) 555-6503 now", 1), ("tel 212-555-0143", 1), ("fax 030-123-4567 or mobile 499.555.6503", 1),
    ("serial 100-200-3000 part", 0), ("order 555-123-4567 shipped", 0), ("ref 212.555.0143 page", 0), ("x=212-555-0143", 0),
    ("host 2001:db8:0:0:0:0:2:1 up", 1), ("server addr fe80::1ff:2", 1), ("ip ::1", 1), ("section 1::2 and", 0), ("std a::b", 0), ("code dead::beef here", 0),
    ("ip 999.10.0.0.1 up", 1), ("version 1.2.3.4.5.6.7.999", 0),
    ("pay 4111.1111.1111.1111 ok", 1), ("card 3782_822463_10005", 1), ("visa 12 4111111111111111", 1), ("credit 5555,5555,5555,4444", 1), ("see 12 4012888888881881 there", 1),
    ("serial 12 9999999999999995", 0), ("hash 1234567890123456789012345678901234567890", 0), ("token 99 0000000000000000", 0), ("checksum 77 1234567812345670", 0),
    ("call +1 499 555 6503 22 33 44 55 now", 1), ("phone +4930123456712345678", 1), ("id +1234567890123456789", 0),
)
SEED_ROWS = 5           # each seed's candidates count as so many


def _luhn(digits: Column) -> Column:
    size = F.char_length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, size - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), size), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid_part(kind: str, part: Column) -> Column:
    """The card check on a part (the patterns of the other kinds' parts are their checks)."""
    return F.call_function("luhn_check", F.regexp_replace(part, "[^0-9]", "")) if kind == "card" else F.lit(True)


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.char_length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.char_length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)


def _bins(value: Column, *limits: int) -> Column:
    """How many limits the value reaches."""
    out = F.lit(0)
    for limit in limits:
        out = out + (value >= limit).cast("int")
    return out


def _form(kind: str, match: Column) -> Column:
    """How a candidate is written: e-mail 0 plain, 1 with bracketed words or a sign apart, 2 with
    the word "at", 3 with the words "at" and "dot", 4 ending in "dot"; card 1 with the digits of a scheme; IPv6 1
    with four groups or more, 2 with fewer; phone 1 with a bracket or plus."""
    if kind == "email":
        return (F.when(match.rlike(rf"(?i){_AT}|{_DOT}"), 1).when(F.contains(match, F.lit("@")), F.when(match.rlike(r"\s"), 1).otherwise(0))
                .when(match.rlike(r"(?i)\bdot$"), 4).when(match.rlike(r"(?i) dot "), 3).otherwise(2))
    if kind == "card":
        return F.regexp_replace(match, "[^0-9]", "").rlike(_SCHEMES).cast("int")
    if kind == "ip":
        groups = F.size(F.filter(F.split(match, ":"), lambda g: g != ""))
        return F.when(~F.contains(match, F.lit(":")), 0).when(groups >= 4, 1).otherwise(2)
    return match.rlike(r"^[+(]").cast("int")


def _weak(s: Column) -> Column:
    """1 or 0 where form and context leave little doubt about a candidate that is no base match, else -1."""
    touching, named, other, form = s["before"] >= 2, s["hint"] == 1, s["hint"] == 2, s["form"]
    rules = {
        "email": F.when((form == 4) | (form >= 2) & ~named, 0).when(form == 1, 1),
        "ip": F.when(other | (form == 2) & ~named, 0).when(named, 1),
        "card": F.when(other & (form == 0), 0).when(named & (form == 1), 1),
        "phone": F.when(other | touching & (form == 0), 0).when(named, 1)}
    out = F.when(F.lit(False), 0)
    for kind, rule in rules.items():
        out = out.when(s["kind"] == KINDS.index(kind), rule)
    return F.coalesce(out, F.lit(-1))


def _span(kind: str, strict: bool, start: Column, match: Column, before: Column) -> Column:
    """A candidate: place, check and features.  ``before``: the characters in front of it."""
    hint = F.when(F.lower(before).rlike(rf"\b(?:{_OTHERS[kind]})\b"), 2).when(F.lower(before).rlike(_WORDS[kind]), 1).otherwise(0)
    edge = F.when(before == "", 0).when(before.rlike(r"[\x20\x09-\x0D]$"), 1).when(before.rlike("[A-Za-z0-9]$"), 2).otherwise(3)
    fields = {
        "kind": F.lit(KINDS.index(kind)), "start": start, "stop": start + F.char_length(match), "ok": _valid(kind, match) if strict else F.lit(False),
        "digits": _bins(F.char_length(F.regexp_replace(match, "[^0-9]", "")), 1, 4, 8, 9, 10, 12, 13, 15, 16, 17, 20),
        "parts": _bins(F.size(F.split(match, r"[^A-Za-z0-9]+")), 2, 3, 4, 5, 6), "letters": match.rlike("[A-Za-z]").cast("int"), "before": edge, "hint": hint,
        "form": _form(kind, match)}
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def _placed(kind: str, strict: bool, parts: Column, copies: int = 0) -> Column:
    """Spans of the fenced matches: ``parts`` are the texts between and in the fences, in turn.
    With ``copies``, each text is followed by so many copies of spans that start after it (a
    copy that is empty is none)."""
    nothing = F.array().cast(SPAN)
    turn = max(copies, 1) + 1       # divides BLOCK
    state = lambda at, seen, out: F.struct(at.alias("at"), seen.alias("seen"), out.alias("out"))

    def step(acc: Column, part: Column) -> Column:
        span = F.array(_span(kind, strict, acc["at"], part["text"], acc["seen"])).cast(SPAN)
        if copies:
            wanted = part["in"] & (part["text"] != "") & _valid_part(kind, part["text"])
            return state(F.when(part["in"], acc["at"]).otherwise(acc["at"] + F.char_length(part["text"])),
                         F.when(part["in"], acc["seen"]).otherwise(F.right(F.concat(acc["seen"], F.right(part["text"], F.lit(CONTEXT))), F.lit(CONTEXT))),
                         F.when(wanted, F.concat(acc["out"], span)).otherwise(acc["out"]))
        return state(acc["at"] + F.char_length(part["text"]), F.right(part["text"], F.lit(CONTEXT)),
                     F.when(part["in"], F.concat(acc["out"], span)).otherwise(acc["out"]))

    def block(acc: Column, some: Column) -> Column:
        before = F.element_at(acc, -1)
        return F.concat(acc, F.array(F.aggregate(some, state(before["at"], before["seen"], nothing), step)))

    marked = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.transform(
        F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)), lambda p, i: F.struct(p.alias("text"), (i % turn != 0).alias("in"))))
    blocks = F.aggregate(marked, F.array(state(F.lit(0), F.lit(""), nothing)), block)
    return F.when(F.size(parts) > 1, F.flatten(F.transform(blocks, lambda x: x["out"]))).otherwise(nothing)


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` (per kind in order, then by start; valid or not) and ``_loose``
    (loose matches and parts of failing runs: these may overlap and repeat).  Names of
    ``docs`` that are used here raise; ``redact`` and ``find_pii`` take any."""
    keep = docs.columns
    taken = [c for c in keep if c.lower() in ("_clean", "_digit", "_base", "_loose", "_valid", "_found", "_added", "_spans") or re.match("_(base|loose|part)_", c.lower())]
    if taken:
        raise ValueError(f"columns {taken} have names that are used here")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_clean", F.when(F.contains(text, F.lit(FENCE)), F.translate(text, FENCE, STAND_IN)).otherwise(text))
    df = df.withColumn("_digit", F.col("_clean").rlike("[0-9]"))
    cut, merged, copied, loose = _steps(docs.sparkSession.sparkContext.applicationId)
    df = df.select(*keep, "_clean", "_digit", *cut)
    df = df.select(*keep, "_clean", "_digit", *merged)
    df = df.select(*keep, "_base", "_loose", *copied)
    return df.select(*keep, "_base", loose)


@functools.lru_cache(maxsize=1)
def _steps(application: str) -> tuple[list[Column], list[Column], list[Column], Column]:
    """The columns of each step of ``with_candidates``: they are made once for an application,
    since there are thousands of expressions in them."""
    sets = [("base", k, p) for k, p in BASE.items()] + [("loose", k, p) for k, p in LOOSE.items()]

    def parts(group: str, kind: str, pattern: str) -> Column:
        need = _NEEDS.get((group, kind))
        wanted = F.contains("_clean", F.lit(need)) if need else F.col("_digit")
        if (group, kind) == ("base", "phone"):
            wanted = wanted & F.col("_digit")
        if (group, kind) == ("loose", "email"):
            wanted = F.col("_clean").rlike("(?i)@| at |[(\\[{<] ?at ?[)\\]}>]")
        fenced = F.regexp_replace("_clean", f"({pattern})", f"{FENCE}$1{FENCE}")
        return F.when(wanted, F.split(fenced, FENCE)).otherwise(F.array().cast("array<string>")).alias(f"_{group}_{kind}")

    def copied(kind: str, failing: bool, start: str, spans: tuple[str, ...]) -> Column:
        """The text with copies, cut at the fences."""
        wanted = F.exists("_base", lambda s: (s["kind"] == KINDS.index(kind)) & ~s["ok"]) if failing else F.col("_digit")
        some = "|".join(f"(?:{s})" for s in spans)
        fenced = F.regexp_replace("_clean", f"{start}(?={some})" + "".join(f"(?:(?=({s}))|)" for s in spans),
                                  FENCE + FENCE.join(f"${i + 1}" for i in range(len(spans))) + FENCE)
        return F.when(wanted, F.split(fenced, FENCE)).otherwise(F.array().cast("array<string>"))

    merged = [F.concat(*(_placed(k, g == "base", F.col(f"_{g}_{k}")) for group, k, _ in sets if group == g)).alias(f"_{g}") for g in ("base", "loose")]
    loose = F.concat("_loose", *(_placed(p[0], False, F.col(f"_part_{i}"), len(p[3])) for i, p in enumerate(PARTS))).alias("_loose")
    return [parts(*s) for s in sets], merged, [copied(*p).alias(f"_part_{i}") for i, p in enumerate(PARTS)], loose


# ---------------------------------------------------------------- boosting

Tree = tuple    # (feature, limit, low, high) with sub-trees or leaf values


def _tree_value(tree, row) -> float:
    while isinstance(tree, tuple):
        feature, limit, low, high = tree
        tree = high if row[feature] > limit else low
    return tree


def _fit_tree(rows, gradients, weights, which, depth: int):
    g, h = sum(gradients[i] for i in which), sum(weights[i] for i in which)
    best = None
    if depth:
        for feature in range(len(FEATURES)):
            sums: dict[int, list[float]] = {}
            for i in which:
                s = sums.setdefault(rows[i][feature], [0.0, 0.0])
                s[0] += gradients[i]
                s[1] += weights[i]
            lg = lh = 0.0
            for limit in sorted(sums)[:-1]:
                lg, lh = lg + sums[limit][0], lh + sums[limit][1]
                gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, feature, limit)
    if best is None or best[0] < 1e-6:
        return SHRINK * max(-4.0, min(4.0, g / (h + 1)))
    _, feature, limit = best
    low, high = [i for i in which if rows[i][feature] <= limit], [i for i in which if rows[i][feature] > limit]
    return (feature, limit, _fit_tree(rows, gradients, weights, low, depth - 1), _fit_tree(rows, gradients, weights, high, depth - 1))


class SpanModel:
    """Boosted trees (log odds that a candidate is valid) and a threshold for each kind."""

    def __init__(self, start: float, trees: list[Tree], limits: dict[int, float]):
        self.start, self.trees, self.limits = start, trees, limits

    @classmethod
    def fit(cls, counts: list[tuple[tuple[int, ...], int, int]], calibration: list[tuple[tuple[int, ...], int, int]]) -> SpanModel:
        """``counts`` and ``calibration``: (features, valid, all) of each feature combination that
        occurs.  A kind whose calibration has no candidate that is none, or none that is one, or
        no score from which on enough are, gets no threshold."""
        counts = sorted(counts)
        rows = [c[0] for c in counts]
        good, total = sum(c[1] for c in counts), sum(c[2] for c in counts)
        start = math.log((good + 1) / (total - good + 1))
        margin, trees = [start] * len(rows), []
        for _ in range(ROUNDS if rows else 0):
            p = [1 / (1 + math.exp(-m)) for m in margin]
            tree = _fit_tree(rows, [c[1] - c[2] * q for c, q in zip(counts, p)], [c[2] * q * (1 - q) for c, q in zip(counts, p)], range(len(rows)), 3)
            trees.append(tree)
            margin = [m + _tree_value(tree, r) for m, r in zip(margin, rows)]
        limits = {}
        for kind in range(len(KINDS)):
            at_score: dict[float, list[int]] = {}       # candidates of one score are chosen together
            for row, ok, n in calibration:
                if row[0] == kind:
                    m = round(start + sum(_tree_value(t, row) for t in trees), 9)
                    known = at_score.setdefault(m, [0, 0])
                    known[0] += ok
                    known[1] += n
            if sum(n - ok for ok, n in at_score.values()) == 0:
                continue
            valid = seen = 0
            scores = sorted(at_score, reverse=True)
            for i, m in enumerate(scores):
                valid, seen = valid + at_score[m][0], seen + at_score[m][1]
                if valid >= PRECISION * seen:       # halfway to the next score, which is one too many
                    limits[kind] = (m + scores[min(i + 1, len(scores) - 1)]) / 2
        return cls(start, trees, limits)

    def margin(self, span: Column) -> Column:
        def compiled(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            feature, limit, low, high = tree
            return F.when(span[FEATURES[feature]] > limit, compiled(high)).otherwise(compiled(low))

        out = F.lit(self.start)
        for tree in self.trees:
            out = out + compiled(tree)
        return out

    def chosen(self, span: Column) -> Column:
        """Whether a candidate reaches its kind's threshold (a kind without one adds nothing)."""
        limit = F.lit(None).cast("double")
        for kind, least in self.limits.items():
            limit = F.when(span["kind"] == kind, least - 1e-9).otherwise(limit)
        return F.coalesce(self.margin(span) >= limit, F.lit(False))


def _counted(spans: DataFrame) -> list[tuple[int, bool, tuple[int, ...], int, int]]:
    """(fold, whether base matches, features, valid, all) of the labelled spans (columns fold, base, good, s)."""
    counts = (spans.where(F.col("good") >= 0).groupBy("fold", "base", *(F.col(f"s.{f}").alias(f) for f in FEATURES))
              .agg(F.sum("good").alias("good"), F.count("*").alias("n")).collect())       # bounded by the feature grid
    return [(r["fold"], r["base"], tuple(r[f] for f in FEATURES), r["good"], r["n"]) for r in counts]


def _labelled(candidates: DataFrame, fold: Column) -> DataFrame:
    sides = F.array(*(F.struct(F.lit(base).alias("base"), F.col(name).alias("spans")) for name, base in (("_base", True), ("_loose", False))))
    some = candidates.where((F.size("_base") > 0) | (F.size("_loose") > 0)).select(fold.alias("fold"), F.explode(sides).alias("side"))
    spans = some.select("fold", "side.base", F.explode("side.spans").alias("s"))
    return spans.select("fold", "base", F.when(F.col("base"), F.col("s.ok").cast("int")).otherwise(_weak(F.col("s"))).alias("good"), "s")


def train_spans(candidates: DataFrame, fold: str = "_fold") -> SpanModel:
    """Fit on all labelled candidates of the corpus whose ``fold`` is 0 and the seeds, as counts per
    feature combination; calibrate on those of fold 1 that are no base match, and the seeds."""
    counts = _counted(_labelled(candidates, F.col(fold))) + _seeds(candidates.sparkSession)
    times = lambda f: SEED_ROWS if f < 0 else 1
    return SpanModel.fit(_summed((row, ok * times(f), n * times(f)) for f, _, row, ok, n in counts if f != 1),
                         _summed((row, ok * times(f), n * times(f)) for f, base, row, ok, n in counts if f != 0 and not base))


_KNOWN: dict[tuple, list] = {}


def _seeds(spark: SparkSession) -> list[tuple[int, bool, tuple[int, ...], int, int]]:
    """The seeds' candidates, as counts of fold -1 (they never change, so they are made once)."""
    if SEEDS not in _KNOWN:
        seeds = with_candidates(spark.createDataFrame(SEEDS, "_text string, _good int"), "_text")
        _KNOWN[SEEDS] = _counted(seeds.select(F.lit(-1).alias("fold"), F.lit(False).alias("base"), F.col("_good").alias("good"), F.explode("_loose").alias("s")))
    return _KNOWN[SEEDS]


def _summed(counts) -> list[tuple[tuple[int, ...], int, int]]:
    out: dict[tuple[int, ...], list[int]] = {}
    for row, ok, n in counts:
        known = out.setdefault(row, [0, 0])
        known[0] += ok
        known[1] += n
    return [(row, ok, n) for row, (ok, n) in sorted(out.items())]


def _with_fold(rows: DataFrame) -> DataFrame:
    """The fold of a text: equal texts are in one."""
    return rows.withColumn("_fold", F.pmod(F.xxhash64("_text"), F.lit(2)).cast("int"))


def _ordered(spans: Column) -> Column:
    return F.sort_array(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))


def _joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def select_spans(candidates: DataFrame, model: SpanModel) -> DataFrame:
    """Candidates' columns with ``_found`` (valid base spans) and ``_spans`` (with those added)."""
    keep = [c for c in candidates.columns if c not in ("_base", "_loose")]
    df = candidates.select(*keep, F.filter("_base", lambda s: s["ok"]).alias("_valid"), "_loose")
    df = df.select(*keep, _ordered(F.col("_valid")).alias("_found"), F.when(F.size("_loose") > 0, F.array_distinct(_ordered(F.filter("_loose", lambda s: model.chosen(s) & ~F.exists(
        "_valid", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))))).alias("_added"))
    return df.select(*keep, "_found", F.when(F.col("_added").isNull(), F.col("_found")).otherwise(F.sort_array(F.concat("_found", "_added"))).alias("_spans"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all spans).

    One row per input row; a NULL or empty text has no spans; an empty table gives no rows;
    other columns are left out.  Nothing but the table of feature counts is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    candidates = staged(with_candidates(_with_fold(rows), "_text").drop("_text"), "pii-candidates")
    spans = select_spans(candidates, train_spans(candidates))
    n = lambda k: F.size(F.filter("_found", lambda s: s["kind"] == k)).cast("long")
    return spans.select(F.col("_id").alias(id_col), *(n(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
                        F.sha2(_joined(F.col("_found")), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in brackets.

    Of overlapping spans the first is replaced, and the rest of a longer one goes with it.
    A NULL text stays NULL.  All other columns come through as they are, whatever their
    names and types (those that Parquet holds).  Rows are written once with their candidates,
    from which the model learns and the texts are cleaned.
    """
    at, kept = docs.columns.index(text_col), [f"_kept_{i}" for i in range(len(docs.columns))]
    rows = _with_fold(docs.toDF(*kept).withColumnRenamed(kept[at], "_text"))      # no name of a document can clash
    candidates = staged(with_candidates(rows, "_text"), "pii-candidates")
    found = select_spans(candidates, train_spans(candidates))
    by_place = F.sort_array(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    text = F.col("_text")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        tag = F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]"))
        put = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), tag)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), put.alias("out"))

    done = F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    clean = F.when(F.size("_spans") > 0, done).otherwise(text)
    return found.select(*(clean.alias(c) if i == at else c for i, c in enumerate(kept))).toDF(*docs.columns)
