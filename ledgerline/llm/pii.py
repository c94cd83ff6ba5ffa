"""Personal data by weak supervision, in DataFrame operations only.

Base spans follow fixed patterns and checks and always stay. Besides, looser patterns propose candidates (spelled
out addresses, numbers without a country code, longer address forms, shorter cards). Every span, base or candidate,
gets a vote from each of five labelers: format, checks, gazetteer, context and border. Expectation-maximisation over
the votes of the whole corpus estimates how reliable each labeler is for each kind, without any labelled row, and
gives each span a probability. On those, a logistic span classifier is trained with more features than the votes;
it decides which candidates are added.

The corpus is read once: what is kept of a text are its spans with their votes. Both models see the corpus only as
counts of vote and feature patterns, of which there are a fixed number at most.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import settle

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repeats and the start rule keep long runs linear without changing what
# is found: within a run that could begin a match, the leftmost start is where the run or the search begins.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[3-6][0-9]{3}(?:[\x20-]?[0-9]){9,11}(?![0-9-])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
#: A text without a digit, an at sign or a spelled-out one has no span of any kind.
HINT = r"[0-9@]|[(\[]at[)\]]|\x20at\x20"
# Gazetteers and context words of the labelers, by kind.
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.|^[23][0-9A-Fa-f]{3}:",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|33|34|44|49|[2-9])|^\(?[2-9][0-9]{2}",
}
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reach)[^.]{0,30}$",
    "ip": r"(?i)(?:\bip|address|host|server|login)[^.]{0,30}$",
    "card": r"(?i)(?:card|visa|credit|payment|account)[^.]{0,30}$",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax)[^.]{0,30}$",
}
AGAINST = r"(?i)(?:version|isbn|license|section|chapter|page|token|id)[^.]{0,12}$"
LABELERS = ("format", "check", "gazetteer", "context", "border")
ROUNDS = 30


def _spans(text: Column, pattern: str) -> Column:
    """(start, end, match) of the leftmost non-overlapping matches, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    pairs = F.transform(matches, lambda m, i: F.struct(F.get(gaps, i).alias("gap"), m.alias("match")))
    found = F.aggregate(pairs, empty, lambda done, pair: F.concat(done, F.array(_next(done, pair))))
    return F.when(F.size(matches) > 0, found).otherwise(empty)


def _next(done: Column, pair: Column) -> Column:
    """The span of a match, which begins after the spans so far and the gap before it."""
    start = F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0)) + F.char_length(pair["gap"])
    return F.struct(start.alias("start"), (start + F.char_length(pair["match"])).alias("end"), pair["match"].alias("match"))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: F.when(c == "", 0).otherwise(F.ascii(c) - 48))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _checked(kind: str, match: Column) -> Column:
    """What a base match must pass."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(_digits(match)).between(16, 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _loosely_checked(kind: str, match: Column) -> Column:
    """The same idea for candidates."""
    if kind == "ip":
        return F.lit(True)
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)) == 10
    return match.rlike(r"[(\[]at[)\]]") | match.rlike(r"(?i)\x20at\x20.*\x20dot\x20")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(kind: str, text: Column, spans: Column, base: bool) -> Column:
    """Spans with their labelers' votes and further features, all of few values."""

    def judge(s: Column) -> Column:
        match, end = s["match"], s["end"]
        # plain code points before and after
        left = F.substring(text, F.greatest(s["start"] - 39, F.lit(1)), F.least(s["start"], F.lit(40)))
        right = F.substring(text, end + 1, F.lit(1))
        sound = _checked(kind, match) if base else _loosely_checked(kind, match)
        listed = match.rlike(GAZETTEER[kind])
        glued = left.rlike(r"[A-Za-z0-9_=/\"]$") | right.rlike(r"^[A-Za-z0-9_/\"]")
        votes = [
            F.lit(1 if base else -1),
            _vote(sound, ~sound),
            _vote(listed, ~listed),
            _vote(left.rlike(CONTEXT[kind]), left.rlike(AGAINST)),
            _vote(~glued, glued),
        ]
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(base).alias("base"),
            F.array(*(v.cast("int") for v in votes)).alias("votes"),
            F.least(F.char_length(match) / 8, F.lit(4)).cast("int").alias("size"),
            match.rlike(r"[\x20().-]").cast("int").alias("parted"),
        )

    return F.transform(spans, judge)


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``judged``: base spans and candidates of all kinds, with votes; one row for each of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    hinted = docs.select("doc_id", F.when(text.rlike(HINT), text).otherwise("").alias("text"))

    def sound(kind: str) -> Column:
        return F.filter(_spans(F.col("text"), BASE[kind]), lambda s: _checked(kind, s["match"]))

    base = {k: sound(k) for k in KINDS}
    found = hinted.select("doc_id", "text", *(v.alias(k) for k, v in base.items()))
    loose = {}
    for k in KINDS:
        # nothing that base spans of any kind already cover
        known = F.concat(*KINDS)
        loose[k] = F.filter(_spans(F.col("text"), LOOSE[k]), lambda s: ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = found.select("*", *(v.alias(f"{k}_loose") for k, v in loose.items()))
    parts = [_judged(k, F.col("text"), F.col(c), c == k) for k in KINDS for c in (k, f"{k}_loose")]
    return found.select("doc_id", F.concat(*parts).alias("judged"))


@dataclass(frozen=True)
class SpanModel:
    """Per kind: the prior, each labeler's P(vote | personal or not), and the classifier's weights by feature value."""

    prior: dict[int, float]
    reliability: dict[tuple[int, int, int, int], float]  # (kind, labeler, truth, vote)
    weights: dict[tuple, float]


Pattern = tuple[int, tuple[int, ...], int, int]


def estimate(counts: dict[Pattern, int]) -> SpanModel:
    """EM over labeler votes, then the classifier, from counts of (kind, votes, size, parted)."""
    prior, reliability, posterior = {}, {}, {}
    for kind in sorted({p[0] for p in counts}):
        own: dict[tuple[int, ...], int] = {}
        for (k, votes, _, _), n in counts.items():
            if k == kind:
                own[votes] = own.get(votes, 0) + n
        belief = {v: 1 / (1 + math.exp(-sum(v))) for v in own}  # to begin with, the majority is right
        for _ in range(ROUNDS):
            total = sum(own.values())
            share = (sum(n * belief[v] for v, n in own.items()) + 1) / (total + 2)
            rate = {}
            for i, truth, vote in itertools.product(range(len(LABELERS)), (0, 1), (-1, 0, 1)):
                weight = {v: n * (belief[v] if truth else 1 - belief[v]) for v, n in own.items()}
                hits = sum(w for v, w in weight.items() if v[i] == vote)
                # a labeler is taken to be right more often than not, until the votes tell otherwise
                lean = 2.0 if vote == (1 if truth else -1) else 1.0
                rate[i, truth, vote] = (hits + lean) / (sum(weight.values()) + 4)
            for v in own:
                odds = math.log(share / (1 - share)) + sum(math.log(rate[i, 1, x] / rate[i, 0, x]) for i, x in enumerate(v))
                belief[v] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
        prior[kind] = share
        reliability |= {(kind, *key): p for key, p in rate.items()}
        posterior |= {(kind, v): b for v, b in belief.items()}
    return SpanModel(prior, reliability, _train({p: (n, posterior[p[0], p[1]]) for p, n in counts.items()}))


def features(pattern: Pattern) -> list[tuple]:
    kind, votes, size, parted = pattern
    return [("kind", kind), *(("vote", kind, i, v) for i, v in enumerate(votes)), ("size", kind, size), ("parted", kind, parted)]


def _train(rows: dict[Pattern, tuple[int, float]], steps: int = 200, rate: float = 0.5, ridge: float = 1e-3) -> dict[tuple, float]:
    """Logistic regression on soft labels; each pattern weighs as the logarithm of its count, so rare ones are heard."""
    weights: dict[tuple, float] = dict.fromkeys((f for p in rows for f in features(p)), 0.0)
    total = sum(math.log1p(n) for n, _ in rows.values())
    for _ in range(steps):
        gradient = {f: ridge * w for f, w in weights.items()}
        for p, (n, target) in rows.items():
            own = features(p)
            error = 1 / (1 + math.exp(-max(-30, min(30, sum(weights[f] for f in own))))) - target
            for f in own:
                gradient[f] += error * math.log1p(n) / total
        for f in weights:
            weights[f] -= rate * len(weights) ** 0.5 * gradient[f]
    return weights


def _accepted(model: SpanModel, s: Column) -> Column:
    """The classifier's decision as an expression; base spans stay anyhow."""

    def weight(values: dict[tuple, float], *key: Column) -> Column:
        out = F.lit(0.0)
        for name, w in values.items():
            hit = F.lit(True)
            for k, v in zip(key, name, strict=True):
                hit = hit & (k == F.lit(v))
            out = F.when(hit, w).otherwise(out)
        return out

    by_name: dict[str, dict[tuple, float]] = {"kind": {}, "vote": {}, "size": {}, "parted": {}}
    for f, w in model.weights.items():
        by_name[f[0]][f[1:]] = w
    score = weight(by_name["kind"], s["kind"]) + weight(by_name["size"], s["kind"], s["size"]) + weight(by_name["parted"], s["kind"], s["parted"])
    for i in range(len(LABELERS)):
        own = {(k, v): w for (k, at, v), w in by_name["vote"].items() if at == i}
        score = score + weight(own, s["kind"], F.get(s["votes"], F.lit(i)))
    return s["base"] | (score >= 0)


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of kind, start, end, in that order) for every row of ``docs``.

    Kinds are numbers into ``KINDS``; places are code points, the end exclusive. A null text counts as empty. Rows
    are judged one by one, whatever their ids. A corpus without any candidate learns nothing and adds nothing.
    """
    found = settle(find_spans(docs), "judged-spans")
    each = found.select(F.explode("judged").alias("s")).groupBy("s.kind", "s.votes", "s.size", "s.parted").count()
    counts = {(r["kind"], tuple(r["votes"]), r["size"], r["parted"]): r["count"] for r in each.collect()}
    model = estimate(counts)
    plain = lambda spans: F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    base = F.filter("judged", lambda s: s["base"])
    every = F.filter("judged", lambda s: _accepted(model, s)) if counts else F.col("judged")
    return found.select("doc_id", plain(base).alias("base"), plain(every).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first one counts."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        longer = F.struct(s["end"].alias("at"), F.concat(done["out"], gap, F.lit("["), F.get(names, s["kind"]), F.lit("]")).alias("out"))
        return F.when(s["start"] >= done["at"], longer).otherwise(done)

    return F.aggregate(ordered, start, add, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))))
