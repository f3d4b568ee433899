"""Personal data by weak supervision, with DataFrame functions only.

Base spans are matches of four patterns that pass a check.  Looser patterns give more candidates.  Six labellers
(regex, gazetteer and context) vote on every candidate, expectation-maximisation over the vote patterns of the whole
corpus estimates what their votes are worth, and a linear classifier over the candidates' discrete features is fitted
on the posteriors.  It decides on the loose candidates; base spans stay whatever it says.

A text is scanned once.  Only counts of feature keys reach the driver: a key has ten characters of a few values each,
so their number is bounded whatever the input.

The patterns are those of the contract in a form that takes linear time: repetitions that can't give anything back are
possessive, and a match may only begin where a run of its first class begins, or where the last match ended.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .spans import located, matches, pieces
from .weak import fit, logistic

#: Kinds in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base patterns, by kind, and what a text has to contain to be tried.
LOOSE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:[\[({]dot[\])}]|\.)\x20?[A-Za-z0-9-]{1,63}){1,5}",
        r"at[\])}]",
    ),
    "ip": (r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    "card": (r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", r"[0-9][./_][0-9]"),
    "phone": (
        r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
        r"[0-9][-.\x20][0-9]{4}",
    ),
}
#: Gazetteers and context words of the labellers.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us"
FOR_WORDS = (
    "e-?mail|mail|contact|write|call|phone|tel|telephone|fax|mobile|cell|card|visa|mastercard|pay|ip|host|server|"
    "address|login|from|to"
)
AGAINST_WORDS = (
    "version|ver|v|rev|release|build|section|sec|chapter|fig|figure|table|isbn|issn|doi|id|no|nr|order|invoice|page"
)
AROUND = 24


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, size - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check that a base match has to pass."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _vote(*cases: tuple[Column, int]) -> Column:
    out = F
    for condition, value in cases:
        out = out.when(condition, F.lit(str(value)))
    return out.otherwise(F.lit("0"))


def key(kind: str, form: str, span: Column) -> Column:
    """The features of a candidate: kind, form, six votes, length, share of digits."""
    value, left, right = span["value"], span["left"], span["right"]
    digits = _digits(value)
    if kind == "email":
        shape = _vote(
            (value.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}$"), 2),
            (value.rlike(r"(?i)at[\])}]\x20?[a-z0-9-]+\x20?[\[({.]"), 2),
            (F.lit(True), 1),
        )
        known = _vote((value.rlike(rf"(?i)[.\]\)}}]\x20?(?:{DOMAINS})$"), 2))
    elif kind == "ip":
        shape = _vote((value.rlike(r"(?:^|\.)0[0-9]"), 1), (value.rlike(r"^(?:[1-9]|[0-9A-Fa-f]+:)"), 2))
        known = _vote((value.rlike(r"^(?:0|10|127|255)\.|^192\.168\."), 1))
    elif kind == "card":
        shape = _vote((~luhn(digits), 1), (F.length(digits).between(15, 16), 2))
        known = _vote((digits.rlike(r"^(?:4|5[1-5]|3[47]|6011|65)"), 2))
    else:
        shape = _vote((F.length(digits).between(10, 12) & value.rlike(r"[-.() ]"), 2))
        known = _vote((value.rlike(r"^\+(?:1|33|34|39|44|49)"), 2), (digits.rlike(r"^[01]?[01]"), 1))
    votes = (
        shape,
        known,
        _vote((left.rlike(rf"(?i)\b(?:{FOR_WORDS})\b[^A-Za-z]{{0,4}}$"), 2)),
        _vote((left.rlike(rf"(?i)\b(?:{AGAINST_WORDS})\b\.?[^A-Za-z]{{0,3}}$"), 1)),
        _vote((left.rlike(r"[A-Za-z0-9_/]$") | right.rlike(r"^[A-Za-z0-9_/]"), 1), (right.rlike(r"^[\s,;.)]|^$"), 2)),
        _vote((digits.rlike(r"^(\d)\1{8,}$|123456789"), 1)),
    )
    size = F.least(F.floor(F.length(value) / 8), F.lit(9)).cast("string")
    share = F.least(F.floor(F.length(digits) * 10 / F.length(value)), F.lit(9)).cast("string")
    return F.concat(F.lit(kind[0]), F.lit(form), *votes, size, share)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, loose): arrays of (start, kind number, end, key), sorted; a null text is empty."""
    text = F.col("text")
    step = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    patterns = {f"base_{k}": BASE[k] for k in KINDS} | {f"loose_{k}": LOOSE[k][0] for k in KINDS}
    tried = {
        "base_email": text.contains("@"), "base_ip": text.rlike(r"[0-9]\.[0-9]"), "base_card": text.rlike("[0-9]{1}"),
        "base_phone": text.contains("+"),
    } | {f"loose_{k}": text.rlike(LOOSE[k][1]) for k in KINDS}
    step = step.withColumns({n: matches(text, p, tried[n]) for n, p in patterns.items()})
    step = step.withColumns({f"{n}_cut": pieces(text, p, F.col(n)) for n, p in patterns.items()}).drop("text")
    step = step.select("id", *[located(F.col(n), F.col(f"{n}_cut"), AROUND).alias(n) for n in patterns])

    def shaped(name: str, checked: bool) -> Column:
        form, kind = name.split("_")
        spans = F.col(name)
        if checked:
            spans = F.filter(spans, lambda s: valid(kind, s["value"]))
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                s["end"].alias("end"),
                key(kind, form[0], s).alias("key"),
            ),
        )

    base = F.array_sort(F.concat(*[shaped(f"base_{k}", True) for k in KINDS]))
    loose = F.array_sort(F.concat(*[shaped(f"loose_{k}", False) for k in KINDS]))
    both = step.select("id", base.alias("base"), loose.alias("loose"))
    free = F.filter(
        "loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    )
    return both.select("id", "base", free.alias("loose"))


def train(found: DataFrame) -> dict[int, dict[str, float]]:
    """The classifier: a weight for each character at each place of a key; -1 holds the intercept."""
    keys = found.select(F.explode(F.concat("base", "loose")).alias("c")).groupBy("c.key").agg(F.count("*").alias("n"))
    tally = sorted((r["key"], r["n"]) for r in keys.collect())
    if not tally:
        return {-1: {"": 0.0}}
    counts = np.array([n for _, n in tally], np.float64)
    votes = np.array([[int(c) for c in k[2:8]] for k, _ in tally])
    posterior = fit(votes, counts, prior=0.7)["posterior"]
    slots = sorted({(i, c) for k, _ in tally for i, c in enumerate(k) if i != 1})  # not the form: it isn't evidence
    column = {slot: j for j, slot in enumerate(slots)}
    x = np.zeros((len(tally), len(slots)))
    for row, (k, _) in enumerate(tally):
        for i, c in enumerate(k):
            if i != 1:
                x[row, column[i, c]] = 1.0
    weights = logistic(x, posterior, counts)
    model: dict[int, dict[str, float]] = {-1: {"": float(weights[-1])}}
    for (i, c), j in column.items():
        model.setdefault(i, {})[c] = float(weights[j])
    return model


def chance(model: dict[int, dict[str, float]], key_: Column) -> Column:
    """The classifier's chance that a candidate is personal data."""
    total = F.lit(model[-1][""])
    for place, weights in sorted(model.items()):
        if place >= 0:
            letter, term = F.substring(key_, place + 1, 1), F
            for c, w in sorted(weights.items()):
                term = term.when(letter == c, F.lit(w))
            total = total + term.otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (start, kind, end) in code points, sorted by start, then kind.

    ``kind`` numbers ``KINDS``.  ``spans`` holds the base spans and the loose candidates that the classifier takes.
    """
    found = saved(candidates(docs, id_col, text_col), "candidates")
    model = train(found)
    plain = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    taken = F.filter("loose", lambda c: chance(model, c["key"]) > 0.5)
    return found.select(
        "id",
        F.transform("base", plain).alias("base"),
        F.array_sort(F.transform(F.concat("base", taken), plain)).alias("spans"),
    )


def listed(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
