"""Personal data in texts by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Strict patterns find e-mail addresses, IP addresses, card and phone numbers; what they find always
counts. Wider patterns find candidates, and five labelers vote on each: the strict pattern, a check of the number
or name, a gazetteer of prefixes and endings, cue words around it, and its neighbours. Votes are yes, no
or none. Expectation-maximisation over the counts of vote patterns, 3 ** 5 a kind at most, gives each
labeler's reliability and each candidate's probability; with those as soft labels a naive Bayes classifier over
features of the span (digits, length, shape, neighbours, cues) is trained, a table of fixed
size. Candidates it accepts are added where no strict span lies.

Everything is DataFrame functions. Texts are read once; the candidates of each row stay in the row, so
nothing is joined back, and only counts are grouped. Places are code points, ends exclusive.

A null or empty text has no spans. Rows with equal or null keys are rows of their own. Patterns are
written so that they take time in proportion to a text, however long a run of like characters is. Without
candidates nothing is added. Other columns are kept untouched by :func:`redacted` and not read by :func:`op7`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved

KINDS = ("email", "ip", "card", "phone")
#: The strict patterns. Possessive runs and starts at the head of a run change no match.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)", r"(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)"
WIDE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}{{1,64}}+{_AT}{_DOMAIN}++(?:{_DOT}{_DOMAIN}++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    # a number beside another that the strict pattern takes for one
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{14,19})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?|(?<![0-9])\([0-9]{3}\)|(?<![0-9])[0-9]{3}[.-])[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: Gazetteers: endings of names, first digits of cards, first digits of phone numbers, first parts of addresses no host has.
ENDINGS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|ca|it|nl|ch|at|be|co"
CARDS = "^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35)"
PHONES = r"^(?:\+|00|\(?[2-9][0-9]{2}\)?[\x20.-])"
NO_HOST = r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
#: Cue words of each kind, and words that speak against any.
CUES = {
    "email": "mail|contact|write|correo|courriel",
    "ip": r"\bip\b|host|server|address|serveur|adresse",
    "card": "card|visa|credit|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|anruf|llam|appel",
}
AGAINST = r"isbn|version|\bv[0-9]*$|page|order|invoice|[$€£%]$|http|www|sha|uuid"
VOTES, FEATURES, VALUES = 5, 7, 64
ROUNDS = 10
ACCEPT = 0.9
_SPAN = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]", ""))


def _luhn(c: Column) -> Column:
    digits = F.reverse(F.regexp_replace(c, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _fits(kind: str, c: Column) -> Column:
    """What a strict match must hold besides its pattern."""
    if kind == "ip":
        return F.regexp_like(c, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return F.when(_digits(c).between(14, 19), _luhn(c)).otherwise(False)
    return _digits(c).between(10, 15) if kind == "phone" else F.lit(True)


def _located(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Columns ``__<name>``: matches of each pattern with their places and 24 characters around."""
    for name, pattern in patterns.items():
        df = df.withColumn(f"__m_{name}", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    for name, pattern in patterns.items():
        df = df.withColumn(f"__p_{name}", F.when(F.size(f"__m_{name}") > 0, F.split(text, pattern, -1)))
    for name in patterns:
        m, p = f"__m_{name}", f"__p_{name}"
        spans = f"""aggregate(sequence(0, size({m}) - 1), named_struct('at', 0, 'out', cast(array() AS {_SPAN})), (a, i) -> named_struct(
            'at', a.at + length({p}[i]) + length({m}[i]),
            'out', concat(a.out, array(named_struct('start', a.at + length({p}[i]), 'end', a.at + length({p}[i]) + length({m}[i]),
                'text', {m}[i], 'before', right({p}[i], 24), 'after', left({p}[i + 1], 24)))))).out"""
        df = df.withColumn(f"__{name}", F.when(F.size(m) > 0, F.expr(spans)).otherwise(F.array().cast(_SPAN)))
    return df.drop(*[f"__{x}_{name}" for x in "mp" for name in patterns])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 2).when(no, 1).otherwise(0)


def _candidate(kind: int, s: Column) -> Column:
    """Votes (0 none, 1 no, 2 yes) and features (0 to 63) of a candidate span."""
    name, text, digits = KINDS[kind], s["text"], _digits(s["text"])
    strict = F.regexp_like(text, F.lit(f"^(?:{STRICT[name]})$")) & F.coalesce(_fits(name, text), F.lit(False))
    known = {
        "email": _vote(F.regexp_like(text, F.lit(rf"(?i)[.\])\x20](?:{ENDINGS})$")), ~F.regexp_like(text, F.lit(r"[A-Za-z]{2,}$"))),
        "ip": _vote(~F.regexp_like(text, F.lit(NO_HOST)), F.regexp_like(text, F.lit(NO_HOST))),
        "card": _vote(F.regexp_like(text, F.lit(CARDS)), ~F.regexp_like(text, F.lit(CARDS))),
        "phone": _vote(F.regexp_like(text, F.lit(PHONES)), F.regexp_like(text, F.lit("^[0-9]+$"))),
    }[name]
    check = {
        "email": _vote(F.regexp_like(text, F.lit(r"(?:\.|dot[\])]\x20?)[A-Za-z0-9-]+$")), ~F.regexp_like(text, F.lit(r"[.\])]"))),
        "ip": _vote(_fits("ip", text), ~_fits("ip", text)),
        "card": _vote(_fits("card", text), ~_fits("card", text)),
        "phone": _vote(digits.between(10, 15), digits < 9),
    }[name]
    around = F.lower(F.concat_ws(" ", s["before"], s["after"]))
    cue = _vote(F.regexp_like(around, F.lit(CUES[name])), F.regexp_like(F.lower(F.rtrim(s["before"])), F.lit(AGAINST)))

    def neighbour(c: Column) -> Column:
        return (
            F.when(c == "", 0).when(F.regexp_like(c, F.lit(r"^\s$")), 1).when(F.regexp_like(c, F.lit("^[0-9]$")), 2)
            .when(F.regexp_like(c, F.lit(r"^[\p{L}_]$")), 3).when(F.regexp_like(c, F.lit(r"^[.,;:!?)]$")), 4).otherwise(5)
        )

    left, right = neighbour(F.right(s["before"], F.lit(1))), neighbour(F.left(s["after"], F.lit(1)))
    glued = left.isin(2, 3) | right.isin(2, 3)
    alone = _vote(left.isin(0, 1) & right.isin(0, 1, 4), glued)
    shape = F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]+", "a")
    shape = F.when(F.lit(name == "email"), F.regexp_replace(shape, "9+", "9")).otherwise(shape)
    at_most = lambda c: F.least(c, F.lit(VALUES - 1)).cast("int")
    features = [
        at_most(digits), at_most(F.length(text)), F.pmod(F.xxhash64(shape), F.lit(VALUES)).cast("int"), left, right, cue, known
    ]
    return F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.array(_vote(strict, F.lit(False)), check, known, cue, alone).alias("votes"), F.array(*features).alias("features"),
    )


def _fitting(kind: str) -> Callable[[Column], Column]:
    return lambda s: _fits(kind, s["text"])


def _voted(kind: int) -> Callable[[Column], Column]:
    return lambda s: _candidate(kind, s)


def _strict(number: int, kind: str) -> Column:
    return F.transform(F.filter(f"__{kind}", _fitting(kind)), lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def _number_of(kind: int) -> Column:
    return F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long")


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base``, the strict spans in order, and ``__candidates``, the wider ones with votes and features."""
    whole = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    found = _located(whole, "__text", STRICT | {f"wide_{k}": p for k, p in WIDE.items()})
    base = [_strict(i, k) for i, k in enumerate(KINDS)]
    # a number that fails its check is no candidate: labelers may not outvote arithmetic
    wide = [F.transform(F.filter(f"__wide_{k}", _fitting(k)) if k in ("ip", "card") else F.col(f"__wide_{k}"), _voted(i)) for i, k in enumerate(KINDS)]
    return (
        found.withColumn("__base", F.array_sort(F.concat(*base))).withColumn("__candidates", F.concat(*wide))
        .drop("__text", *[f"__{n}{k}" for k in KINDS for n in ("", "wide_")])
    )


def reliabilities(patterns: DataFrame) -> list[dict]:
    """By kind: the log odds of the prior, and of a no and a yes of each labeler, from counts of vote patterns."""
    start = [{"prior": 0.0, "no": [-1.0] * VOTES, "yes": [1.0] * VOTES} for _ in KINDS]
    model = start
    for _ in range(ROUNDS):
        p = F.col("p")
        with_p = patterns.withColumn("p", 1 / (1 + F.exp(-log_odds(model, F.col("kind"), F.col("votes")))))
        sums = [F.sum(F.col("n") * p).alias("all1"), F.sum(F.col("n") * (1 - p)).alias("all0")]
        for i in range(VOTES):
            for vote in (1, 2):
                has = F.when(F.element_at("votes", i + 1) == vote, F.col("n")).otherwise(0)
                sums += [F.sum(has * p).alias(f"v{i}_{vote}_1"), F.sum(has * (1 - p)).alias(f"v{i}_{vote}_0")]
        model = [dict(m) for m in model]
        for r in with_p.groupBy("kind").agg(*sums).collect():  # a row a kind
            ratio = lambda a, b: math.log((a + 1) / (b + 1))
            total = ratio(r["all1"], r["all0"])
            # a labeler's vote is worth how much oftener it falls on one class than on the other; never against its sense
            model[r["kind"]] = {
                "prior": total,
                "no": [min(0.0, ratio(r[f"v{i}_1_1"], r[f"v{i}_1_0"]) - total) for i in range(VOTES)],
                "yes": [max(0.0, ratio(r[f"v{i}_2_1"], r[f"v{i}_2_0"]) - total) for i in range(VOTES)],
            }
    return model


def log_odds(model: list[dict], kind: Column, votes: Column) -> Column:
    prior = F.element_at(F.array(*[F.lit(float(m["prior"])) for m in model]), kind + 1)
    worth = F.array(*[F.array(*[F.lit(float(x)) for i in range(VOTES) for x in (0.0, m["no"][i], m["yes"][i])]) for m in model])
    of_kind = F.element_at(worth, kind + 1)
    return prior + sum((F.element_at(of_kind, F.element_at(votes, i + 1) + 3 * i + 1) for i in range(VOTES)), F.lit(0.0))


def classifier(candidates: DataFrame, model: list[dict]) -> list[float]:
    """Naive Bayes over the features, from soft labels: log odds of each value, by kind and feature, then of each kind."""
    p = 1 / (1 + F.exp(-log_odds(model, F.col("c.kind"), F.col("c.votes"))))
    values = candidates.select("c.kind", p.alias("p"), F.posexplode("c.features").alias("feature", "value"))
    counts = values.groupBy("kind", "feature", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    size = FEATURES * VALUES
    yes, no = [0.0] * (len(KINDS) * size), [0.0] * (len(KINDS) * size)
    for r in counts:  # len(KINDS) * FEATURES * VALUES rows at most
        at = r["kind"] * size + r["feature"] * VALUES + r["value"]
        yes[at], no[at] = r["yes"], r["no"]
    table = [0.0] * (len(KINDS) * size)
    priors = []
    for kind in range(len(KINDS)):
        for f in range(FEATURES):
            at = kind * size + f * VALUES
            y, n = sum(yes[at : at + VALUES]), sum(no[at : at + VALUES])
            for v in range(at, at + VALUES):
                table[v] = math.log((yes[v] + 0.5) / (y + 0.5 * VALUES)) - math.log((no[v] + 0.5) / (n + 0.5 * VALUES))
        priors.append(math.log((sum(yes[at : at + VALUES]) + 1) / (sum(no[at : at + VALUES]) + 1)))
    return table + priors


def spans(docs: DataFrame, text: str = "text", accept: float = ACCEPT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: the strict spans, and all spans, as (start, kind, end) in order.

    ``keep`` names the columns wanted, by default all; without the text, no text is written.
    """
    wanted = docs.columns if keep is None else keep
    rows = saved(labelled(docs, text).select(*wanted, "__base", "__candidates"), "labelled")
    candidates = rows.select(F.explode("__candidates").alias("c"))
    patterns = saved(candidates.groupBy("c.kind", "c.votes").agg(F.count(F.lit(1)).alias("n")), "votes")
    model = reliabilities(patterns)
    worth = F.array(*[F.lit(float(x)) for x in classifier(candidates, model)])
    size = FEATURES * VALUES

    def accepted(c: Column) -> Column:
        score = F.element_at(worth, len(KINDS) * size + c["kind"] + 1)
        for f in range(FEATURES):
            score = score + F.element_at(worth, c["kind"] * size + f * VALUES + F.element_at(c["features"], f + 1) + 1)
        apart = ~F.exists("__base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return apart & (score > math.log(accept / (1 - accept))) & (log_odds(model, c["kind"], c["votes"]) > 0)

    added = F.transform(F.filter("__candidates", accepted), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return rows.withColumn("__spans", F.array_sort(F.concat("__base", added))).drop("__candidates")


def _printed(column: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op7(docs: DataFrame) -> DataFrame:
    """Counts of the strict spans by kind, their digest, and all spans of all documents."""
    found = spans(docs.select("doc_id", "text"), keep=["doc_id"])
    count = [_number_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(_printed("__base").cast("binary"), 256).alias("base_sha256"), _printed("__spans").alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; of overlapping spans the first counts."""
    found = spans(docs, text)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    apart = F.aggregate(
        "__spans", F.expr("cast(array() AS array<struct<start:int,kind:int,end:int>>)"),
        lambda out, s: F.when(F.coalesce(F.try_element_at(out, F.lit(-1))["end"], F.lit(0)) > s["start"], out).otherwise(F.concat(out, F.array(s))),
    )
    found = found.withColumn("__spans", F.when(F.size("__spans") > 1, apart).otherwise(F.col("__spans")))
    source = F.col(text)
    ends = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["end"]))
    parts = F.transform(
        "__spans",
        lambda s, i: F.concat(F.substring(source, F.element_at(ends, i + 1) + 1, s["start"] - F.element_at(ends, i + 1)), F.element_at(names, s["kind"] + 1)),
    )
    rest = F.substring(source, F.element_at(ends, -1) + 1, F.length(source))
    clean = F.when(F.size("__spans") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(source)
    return found.withColumn(text, clean).select(docs.columns)
