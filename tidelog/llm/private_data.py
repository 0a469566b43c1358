"""Personal data by weak supervision, in column expressions only.

Fixed patterns find the base spans. Further candidates are voted on by labelers
(patterns, a gazetteer of telling words, the characters around), each of which may
abstain. Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is (Dawid and Skene, 1979); the posteriors are the targets of a
logistic span classifier, which is compiled into a column expression.

A vote pattern is a few small integers, so the counts that come to the driver are
bounded by the number of patterns, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.graph import stored

# Possessive repeats, and no start within a run that an earlier start has tried: same
# matches as the plain patterns, in linear time and without deep recursion.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
EXTRA = ("address", "number", "secret")

# Candidates of the three further kinds: written-out addresses, grouped digits, long tokens.
_AT = r"(?:@|\x20?[\[(]at[\])]\x20?)"
_DOT = r"(?:\.|\x20?[\[(]dot[\])]\x20?)"
CANDIDATES = (
    rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
    r"|(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{32,}+"
    r"|(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z])"
)

#: Fixed words that announce personal data, in the languages of the texts.
TELLING = (
    "address", "bearer", "card", "contact", "credential", "email", "fax", "iban", "key", "mail", "mobile",
    "passport", "password", "phone", "pin", "pwd", "secret", "ssn", "tel", "token",
    "correo", "clave", "tarjeta", "telefono", "teléfono",
    "carte", "courriel", "mot de passe", "téléphone",
    "ausweis", "handy", "karte", "kennwort", "passwort", "telefon",
)
CONTEXT = 32
ASSUMED, ASSUMED_WEIGHT = 0.8, 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _byte(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?!$)", "")
    return (F.length(short) <= 3) & (short.cast("int") <= 255)


VALID: Mapping[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), _byte),
    "card": lambda m: F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}


PART = 256  # entries of an array that are worked through in one go


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(
    items: Column, value: Callable[[Column], Column], join: Callable[[Column, Column], Column], start: int,
    made: Callable[[Column, Column], Column], kind: str,
) -> Column:
    """``made(item, so far)`` for every entry: ``so far`` joins the values of the entries before it.

    An array that grows by an entry is copied whole, so entries go through in parts of
    ``PART``: the time grows with the array, not with its square.
    """
    zero, none = F.lit(start).cast("bigint"), F.array().cast(f"array<{kind}>")

    def opened(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda held, x: join(held, value(x))))
        begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("all"))
        openings = F.aggregate(
            totals, begin,
            lambda held, t: F.struct(join(held["at"], t).alias("at"), F.concat(held["all"], F.array(held["at"])).alias("all")),
            lambda held: held["all"],
        )
        return F.arrays_zip(parts.alias("part"), openings.alias("at"))

    def worked(pair: Column) -> Column:
        return F.aggregate(
            pair["part"], F.struct(pair["at"].alias("at"), none.alias("all")),
            lambda held, x: F.struct(
                join(held["at"], value(x)).alias("at"), F.concat(held["all"], F.array(made(x, held["at"]))).alias("all")
            ),
            lambda held: held["all"],
        )

    def whole(entries: Column) -> Column:
        last = F.greatest(F.ceil(F.size(entries) / PART) - 1, F.lit(0)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(entries, k * PART + 1, F.lit(PART)))
        return F.flatten(_bound(parts, lambda p: F.transform(opened(p), worked)))

    return _bound(items, whole)


_SPAN = "struct<s:bigint,e:bigint,text:string,before:string>"


def matches(text: Column, pattern: str) -> Column:
    """Matches from left to right: code points ``s`` to ``e``, the text, and what stands before it."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(between.alias("gap"), found.alias("text"))

    def span(pair: Column, at: Column) -> Column:
        begin = at + F.length(pair["gap"])
        return F.struct(
            begin.cast("bigint").alias("s"), (begin + F.length(pair["text"])).cast("bigint").alias("e"),
            pair["text"].alias("text"), F.lower(F.right(pair["gap"], F.lit(CONTEXT))).alias("before"),
        )

    length = lambda pair: (F.length(pair["gap"]) + F.coalesce(F.length(pair["text"]), F.lit(0))).cast("bigint")
    # What follows the last match has no text.
    return F.filter(running(pairs, length, lambda a, b: a + b, 0, span, _SPAN), lambda m: m["text"].isNotNull())


_FAR = 1 << 60


def clear_of(candidates: Column, base: Column) -> Column:
    """The candidates that touch no base span, in order: each looks at the spans before and after it, not at all."""
    event = "struct<s:bigint,e:bigint,own:int,i:int>"
    own = F.transform(candidates, lambda c, i: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.lit(1).alias("own"), i.alias("i")))
    others = F.transform(base, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"), F.lit(0).alias("own"), F.lit(-1).alias("i")))
    events = F.array_sort(F.concat(others, own).cast(f"array<{event}>"))  # a span that begins with a candidate comes before it
    never = lambda x, touched: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(touched, 2).otherwise(x["own"]).alias("own"), x["i"].alias("i"))
    before = running(
        events, lambda x: F.when(x["own"] == 0, x["e"]).otherwise(F.lit(-1).cast("bigint")), F.greatest, -1,
        lambda x, end: never(x, (x["own"] == 1) & (end > x["s"])), event,
    )
    after = running(
        F.reverse(before), lambda x: F.when(x["own"] == 0, x["s"]).otherwise(F.lit(_FAR).cast("bigint")), F.least, _FAR,
        lambda x, begin: never(x, (x["own"] == 1) & (begin < x["e"])), event,
    )
    free = F.filter(F.reverse(after), lambda x: x["own"] == 1)
    return F.transform(free, lambda x: F.get(candidates, x["i"]))


def _when(test: Column, spans: Column) -> Column:
    return F.when(test, spans).otherwise(F.array().cast("array<struct<s:bigint,e:bigint,text:string,before:string>>"))


def _only(spans: Column, valid: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda m: valid(m["text"]))


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base spans of each kind, and the candidates (array columns)."""
    text = F.col("text")
    digit = F.col("has_digit")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("has_digit", text.rlike("[0-9]"))
    spans = {
        "email": _when(F.contains(text, F.lit("@")), matches(text, EMAIL)),
        "ip": _when(digit & F.contains(text, F.lit(".")), matches(text, IP)),
        "card": _when(digit, matches(text, CARD)),
        "phone": _when(digit & F.contains(text, F.lit("+")), matches(text, PHONE)),
    }
    rows = rows.withColumns({k: _only(v, VALID[k]) for k, v in spans.items()})
    maybe = digit | text.rlike(r"@|[\[(]at[\])]|[A-Za-z0-9_+/=-]{32}")
    return rows.select(
        "doc_id", *[F.transform(k, lambda m: F.struct(m["s"], m["e"])).alias(k) for k in BASE],
        _when(maybe, matches(text, CANDIDATES)).alias("candidates"),
    )


def kind_of(span: Column) -> Column:
    text = span["text"]
    return (
        F.when(text.rlike(r"@|[\[(]at[\])]"), "address").when(text.rlike(r"^[+\x20().0-9-]+$"), "number").otherwise("secret")
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


LABELERS: Mapping[str, Callable[[Column], Column]] = {
    # patterns
    "address_form": lambda c: _vote(
        c["text"].rlike(r"[A-Za-z0-9-]\.[A-Za-z]{2,}$|[\[(]dot[\])]"), c["text"].rlike(r"@.*\.[0-9]+$")
    ),
    "check_digit": lambda c: _vote(
        F.length(_digits(c["text"])).between(13, 19) & (kind_of(c) == "number") & F.call_function("luhn_check", _digits(c["text"])),
        F.length(_digits(c["text"])).between(13, 19) & (kind_of(c) == "number"),
    ),
    "phone_form": lambda c: _vote(
        c["text"].rlike(r"^\+[0-9][\x20().0-9-]{7,}$|^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"),
        c["text"].rlike(r"^[0-9]{7,12}$|^[0-9]{1,4}([/-][0-9]{1,2}){2}$|^[0-9]+(\x20[0-9]{1,2})+$"),
    ),
    "dotted_quad": lambda c: _vote(
        c["text"].rlike(r"^((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.(?=[0-9])|$)){4}$"), c["text"].rlike(r"^[0-9]+(\.[0-9]+)+$")
    ),
    "token_form": lambda c: _vote(
        c["text"].rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/-]{32,}=*$"),
        (kind_of(c) == "secret") & ~c["text"].rlike("[0-9]"),
    ),
    # gazetteer
    "telling_word": lambda c: _vote(c["before"].rlike(r"(^|[^\p{L}])(" + "|".join(TELLING) + r")[^\n]{0,12}$"), F.lit(False)),
    # context
    "assigned": lambda c: _vote(c["before"].rlike(r"[:=]\x20?[\"']?$"), c["before"].rlike(r"[$€£§]\x20?$|[0-9][,.]$")),
    "in_prose": lambda c: _vote(
        c["before"].rlike(r"\p{L}[\x20\"(]+$") & (kind_of(c) == "address"),
        c["before"].rlike(r"[a-z][\x20]+$") & c["text"].rlike("^[0-9]{7,12}$"),
    ),
}


def posteriors(patterns: Mapping[tuple[int, ...], int], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """The probability that a candidate of each vote pattern is personal data, by EM.

    A labeler that doesn't abstain is right with a probability of its own in each class.
    Estimates start from the majority and lean on an assumed reliability, or else few
    classes of candidates could not tell a labeler's errors from its hits; the share of
    personal data leans on a half alike. Deterministic.
    """
    if not patterns:
        return {}
    labelers, whole = len(next(iter(patterns))), sum(patterns.values())
    belief = {p: min(max(0.5 + 0.4 * sum(p), 0.05), 0.95) for p in patterns}
    for _ in range(rounds):
        # Votes of -1 and +1 by class, over the assumed ones.
        votes = [[{-1: 0.0, 1: 0.0} for _ in range(labelers)] for _ in range(2)]
        for own, right in ((votes[0], -1), (votes[1], 1)):
            for count in own:
                count[right] += ASSUMED * ASSUMED_WEIGHT * whole
                count[-right] += (1 - ASSUMED) * ASSUMED_WEIGHT * whole
        for p, n in patterns.items():
            for j, vote in enumerate(p):
                if vote:
                    votes[1][j][vote] += n * belief[p]
                    votes[0][j][vote] += n * (1 - belief[p])
        share = (sum(n * belief[p] for p, n in patterns.items()) / whole + 0.5) / 2
        for p in patterns:
            odds = math.log(share / (1 - share))
            for j, vote in enumerate(p):
                if vote:  # an abstention says nothing
                    yes, no = votes[1][j], votes[0][j]
                    gain = math.log(yes[vote] / (yes[1] + yes[-1])) - math.log(no[vote] / (no[1] + no[-1]))
                    odds += vote * max(vote * gain, 0.0)  # no labeler is worse than chance
            belief[p] = 1 / (1 + math.exp(-max(min(odds, 30.0), -30.0)))
    return belief


def _features(votes: Sequence[int], kind: str) -> list[float]:
    return [1.0, *[float(v == 1) for v in votes], *[float(v == -1) for v in votes], *[float(kind == k) for k in EXTRA]]


def fit_classifier(rows: Sequence[tuple[tuple[int, ...], str, int, float]], rounds: int = 400) -> list[float]:
    """Logistic weights for the features, from (votes, kind, count, target); ridge-regularised."""
    width = 1 + 2 * len(LABELERS) + len(EXTRA)
    weights, whole = [0.0] * width, sum(n for *_, n, _ in rows) or 1
    cases = [([i for i, x in enumerate(_features(v, k)) if x], n / whole, t) for v, k, n, t in rows]
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for own, share, target in cases:
            error = 1 / (1 + math.exp(-sum(weights[i] for i in own))) - target
            for i in own:
                slope[i] += share * error
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _score(candidate: Column, weights: Sequence[float]) -> Column:
    votes, count = [f(candidate) for f in LABELERS.values()], len(LABELERS)
    total = F.lit(weights[0])
    for j, vote in enumerate(votes):
        total += F.when(vote == 1, weights[1 + j]).when(vote == -1, weights[1 + count + j]).otherwise(0.0)
    kind = kind_of(candidate)
    for j, name in enumerate(EXTRA):
        total += F.when(kind == name, weights[1 + 2 * count + j]).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def learn(found: DataFrame) -> list[float]:
    """Weights of the span classifier, from the candidates of all texts."""
    one = F.col("c")
    votes = found.select(F.explode("candidates").alias("c")).select(
        *[f(one).alias(name) for name, f in LABELERS.items()], kind_of(one).alias("kind")
    )
    counts = votes.groupBy(*LABELERS, "kind").agg(F.count("*").alias("n")).collect()  # 3^8 x 3 rows at most
    counts = sorted((tuple(r[name] for name in LABELERS), r.kind, r.n) for r in counts)
    patterns: dict[tuple[int, ...], int] = {}
    for vote, _, n in counts:
        patterns[vote] = patterns.get(vote, 0) + n
    belief = posteriors(patterns)
    return fit_classifier([(vote, kind, n, belief[vote]) for vote, kind, n in counts])


def _written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda m: F.concat_ws(":", F.lit(kind), m["s"].cast("string"), m["e"].cast("string")))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda c: kind_of(c) == kind)


def private_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans as text, and counts of the further kinds.

    Spans are code points, end exclusive; a candidate that touches a base span is left
    to it. A null or empty text has no spans. Repeated rows have a row each; other
    columns are not read. With no candidates anywhere only base spans are found.
    """
    found = stored(found_spans(docs), "spans")
    weights = learn(found)
    base = F.concat(*[F.col(k) for k in BASE])
    likely = F.filter("candidates", lambda c: _score(c, weights) >= 0.5)
    free = F.when(F.size("likely") > 0, clear_of(F.col("likely"), F.col("base"))).otherwise(F.col("likely"))
    rows = stored(found.withColumn("base", base).withColumn("likely", likely), "likely").withColumn("accepted", free)
    written = F.concat(*[_written(k, F.col(k)) for k in BASE])
    further = F.concat(*[_written(k, _of_kind(F.col("accepted"), k)) for k in EXTRA])
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(written, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(written, further), ",").alias("spans"),
        *[F.size(_of_kind(F.col("accepted"), k)).cast("long").alias(f"n_{k}") for k in EXTRA],
    )
