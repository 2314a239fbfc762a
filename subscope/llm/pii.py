"""Personal data by weak supervision, in DataFrame functions only.

Candidates are what the strict patterns find (the base) and what looser ones find. Labelers vote on
each candidate: the strict pattern with its check, a gazetteer, the words before it, and its edges.
A labeler may abstain. Expectation-maximisation over the counted vote patterns estimates how reliable
each labeler is; a logistic span classifier is trained on the resulting probabilities with features
of its own. Both see a table of at most a few hundred counted patterns, however many texts there are.
A span is reported if it is in the base, or if the classifier accepts it and no base span meets it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, in a form that takes linear time and no recursion. Possessive
# quantifiers stand where nothing can be given back, and a match cannot begin inside a run that
# failed from its start.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser patterns. For cards the base pattern finds the loose ones too.
LOOSE = {
    "email": rf"(?<!{_NAME}){_NAME}++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": None,
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# What a text must hold for the patterns to be tried.
HINT = {"email": r"@|[\[(]at[\])]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9]{2}|[0-9][\\x20-][0-9]", "phone": r"\+[0-9]|[0-9][\x20.-][0-9]"}
_OCTET = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
# Gazetteers as patterns over the candidate (endings of mail hosts, ranges of unicast
# addresses, issuer prefixes, calling codes and reserved exchanges).
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|it|nl|ch|at)$",
    "ip": rf"^(?!0+\.|0*127\.|0*2(?:2[4-9]|[345][0-9])\.){_OCTET}\.|^2[0-9A-Fa-f]{{3}}:|^f[cde]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9]))",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|555",
}
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel)[^A-Za-z]*\w*[^A-Za-z]*$",
    "ip": r"(?i)(?:\bip\b|host|server|address|client|from)[^A-Za-z]*$",
    "card": r"(?i)(?:card|visa|master|amex|pay|karte|carte|tarjeta)[^A-Za-z]*$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|ruf)[^A-Za-z]*$",
}
#: Characters before a candidate that the context labeler reads.
BEFORE = 24
CHUNK = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda a, x: a + x)


def matches(text: Column, pattern: str) -> Column:
    """(start, end, match, before, after) of the leftmost non-overlapping matches, in code points;
    ``before`` has up to ``BEFORE`` characters, ``after`` one.

    The text between matches and the matches themselves come from two passes of one pattern; their
    lengths are summed in chunks, and what is around a match is put together from its neighbours, so
    that many matches stay cheap.
    """

    def placed(x: Column) -> Column:
        gap = F.transform(x["gaps"], lambda g: F.char_length(g))
        size = F.transform(x["found"], lambda m: F.char_length(m))
        tails = F.transform(x["gaps"], lambda g: F.right(g, F.lit(BEFORE)))
        heads = F.transform(x["gaps"], lambda g: F.left(g, F.lit(1)))
        return _let(F.struct(gap.alias("gap"), size.alias("size"), x["found"].alias("found"), tails.alias("tails"), heads.alias("heads")), stepped)

    def stepped(x: Column) -> Column:
        step = F.zip_with(x["size"], F.slice(x["gap"], 1, F.size(x["size"])), lambda s, g: s + g)
        chunks = F.sequence(F.lit(0), F.floor((F.size(x["size"]) - 1) / CHUNK).cast("int"))
        return _let(
            F.struct(step.alias("step"), x["gap"].alias("gap"), x["size"].alias("size"), x["found"].alias("found"), chunks.alias("chunks"), x["tails"].alias("tails"), x["heads"].alias("heads")),
            lambda y: _let(
                F.transform(y["chunks"], lambda c: _sum(F.slice(y["step"], c * CHUNK + 1, CHUNK))),
                lambda sums: _let(F.transform(y["chunks"], lambda c: _sum(F.slice(sums, F.lit(1), c))), lambda offsets: spans(y, offsets)),
            ),
        )

    def spans(y: Column, offsets: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            chunk = F.floor(i / CHUNK).cast("int")
            start = F.get(offsets, chunk) + _sum(F.slice(y["step"], chunk * CHUNK + 1, i - chunk * CHUNK)) + F.get(y["gap"], i)
            # the shortest match has four characters, so six of them fill what is looked at
            near = F.sequence(F.greatest(i - 6, F.lit(0)), i)
            pieces = F.transform(near, lambda k: F.concat(F.get(y["tails"], k), F.when(k < i, F.get(y["found"], k)).otherwise("")))
            before = F.right(F.array_join(pieces, ""), F.lit(BEFORE))
            follows = F.concat(F.get(y["heads"], i + 1), F.coalesce(F.get(y["found"], i + 1), F.lit("")))
            return _let(start, lambda s: F.struct(s.alias("start"), (s + F.char_length(m)).alias("end"), m.alias("match"), before.alias("before"), F.left(follows, F.lit(1)).alias("after")))

        return F.transform(y["found"], one)

    return _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(_let(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps")), placed)),
    )


_SPANS = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.lit(True)


def _voted(kind: str, spans: Column, strict: bool) -> Column:
    """Candidates with their votes (1 yes, 0 no, 2 abstains) and the features of the classifier."""

    def one(x: Column) -> Column:
        before = x["before"]
        edge = before.rlike("[A-Za-z0-9_]$") | x["after"].rlike("[A-Za-z0-9_]")
        digits = F.regexp_replace(x["match"], "[^0-9]", "")
        base = _valid(kind, x["match"]) if strict else F.lit(False)
        gazetteer = (digits if kind == "card" else x["match"]).rlike(GAZETTEER[kind])
        votes = F.concat(
            F.when(base, "1").otherwise("0" if strict else "2"),
            F.when(gazetteer, "1").otherwise("0"),
            F.when(before.rlike(CONTEXT[kind]), "1").otherwise("2"),
            F.when(edge, "0").otherwise("2"),
        )
        size = F.char_length(digits)
        shape = F.concat(F.when(x["match"].rlike("[\\x20-]"), "s").otherwise("-"), F.when(size < 8, "a").when(size < 13, "b").when(size < 17, "c").otherwise("d"))
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), base.alias("base"), F.concat(F.lit(f"{kind[0]}|"), votes, F.lit("|"), shape).alias("key"))

    return F.transform(spans, one)


_CANDIDATES = "array<struct<start:int,kind:int,end:int,base:boolean,key:string>>"


def candidates(text: Column) -> Column:
    """All candidates of a text, by start and kind."""
    parts = []
    for kind in KINDS:
        own = _voted(kind, matches(text, BASE[kind]), True)
        if LOOSE[kind]:
            own = F.concat(own, _voted(kind, matches(text, LOOSE[kind]), False))
        parts.append(F.when(text.rlike(HINT[kind]), own).otherwise(F.array().cast(_CANDIDATES)))
    return F.when(text.rlike("[0-9@]|[\\[(]at[\\])]"), F.array_sort(F.concat(*parts))).otherwise(F.array().cast(_CANDIDATES))


def reliabilities(counts: dict[str, int], rounds: int = 40) -> dict[str, float]:
    """P(personal) of every vote pattern by expectation-maximisation, kind by kind.

    The labelers are taken as independent given the truth; the strict pattern is trusted to begin
    with. An abstention says nothing.
    """
    out: dict[str, float] = {}
    for kind in sorted({k[0] for k in counts}):
        own = {k: n for k, n in counts.items() if k[0] == kind}
        votes = {k: k.split("|")[1] for k in own}
        p = {k: 0.95 if v[0] == "1" else 0.5 if v.count("1") > v.count("0") else 0.1 for k, v in votes.items()}
        width = len(next(iter(votes.values())))
        for _ in range(rounds):
            total = sum(own.values())
            prior = (sum(n * p[k] for k, n in own.items()) + 1) / (total + 2)
            rate = []
            for j in range(width):
                for truth in (0, 1):
                    weight = {k: n * (p[k] if truth else 1 - p[k]) for k, n in own.items() if votes[k][j] != "2"}
                    yes = sum(w for k, w in weight.items() if votes[k][j] == "1")
                    # labelers are better than chance: two virtual votes on the right side
                    rate.append((yes + (2 if truth else 0.5)) / (sum(weight.values()) + 2.5))
            for k, v in votes.items():
                odds = math.log(prior / (1 - prior))
                for j, vote in enumerate(v):
                    if vote != "2":
                        a, b = rate[2 * j + 1], rate[2 * j]
                        odds += math.log(a / b) if vote == "1" else math.log((1 - a) / (1 - b))
                p[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        out |= p
    return out


def classifier(counts: dict[str, int], truth: dict[str, float], steps: int = 300) -> dict[str, float]:
    """Logistic scores of every pattern, learned from its probability, weighted by its count."""

    def features(key: str) -> list[str]:
        kind, votes, shape = key.split("|")
        return ["1", kind, *(f"{kind}{j}{v}" for j, v in enumerate(votes)), *(f"{kind}{c}" for c in shape)]

    rows = {k: features(k) for k in counts}
    total = sum(counts.values()) or 1
    # counts act by their root, so that one frequent pattern does not hide the others
    mass = {k: math.sqrt(n / total) for k, n in counts.items()}
    scale = sum(mass.values()) or 1
    weight: dict[str, float] = {f: 0.0 for fs in rows.values() for f in fs}
    score: dict[str, float] = {}
    for _ in range(steps):
        grad = {f: 1e-4 * w for f, w in weight.items()}
        for k, fs in rows.items():
            z = sum(weight[f] for f in fs)
            score[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            gap = (score[k] - truth[k]) * mass[k] / scale
            for f in fs:
                grad[f] += gap
        for f in weight:
            weight[f] -= 2.0 * grad[f]
    return score


def found(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the candidates of every row, written."""
    texts = common.body(docs)
    return common.saved(texts.select("doc_id", F.xxhash64("text").alias("text_key"), candidates(F.col("text")).alias("found")), "candidates")


def accepted(rows: DataFrame) -> list[str]:
    """The patterns that the classifier accepts, trained on the candidates of all rows."""
    patterns = rows.where(F.size("found") > 0).select(F.explode("found.key").alias("key")).groupBy("key").count().collect()  # few: votes and shapes
    counts = {r["key"]: r["count"] for r in patterns}
    score = classifier(counts, reliabilities(counts))
    return sorted(k for k, p in score.items() if p >= 0.5)


def _chunks(items: Column) -> Column:
    """Places of the chunks of a non-empty array."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))


def kept(candidate: Column, patterns: list[str]) -> Column:
    """Base spans, and accepted ones that meet none of them, by start and kind.

    Base spans are held in chunks with the reach of each, so that a span is compared with few.
    """

    def met(base: Column, more: Column) -> Column:
        chunk = lambda c: _let(F.slice(base, c * CHUNK + 1, CHUNK), lambda xs: F.struct(F.array_min(xs["start"]).alias("low"), F.array_max(xs["end"]).alias("high"), xs.alias("items")))
        meets = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
        clear = lambda cs, x: ~F.exists(cs, lambda c: F.when((c["low"] < x["end"]) & (x["start"] < c["high"]), F.exists(c["items"], lambda y: meets(x, y))).otherwise(False))
        return F.when(F.size(base) == 0, more).otherwise(F.concat(base, _let(F.transform(_chunks(base), chunk), lambda cs: F.filter(more, lambda x: clear(cs, x)))))

    def chosen(xs: Column) -> Column:
        more = F.filter(xs, lambda x: ~x["base"] & x["key"].isin(patterns))
        return _let(F.filter(xs, lambda x: x["base"]), lambda base: met(base, more))

    shown = lambda xs: F.transform(xs, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["base"].alias("base")))
    once = lambda xs: F.filter(xs, lambda x, i: (i == 0) | (x != F.get(xs, i - 1)))
    return _let(candidate, lambda xs: F.when(F.size(xs) == 0, F.array().cast(_KEPT)).otherwise(_let(F.array_sort(shown(chosen(xs))), once)))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and ``spans``: array of (start, kind, end, base) by start and kind.

    ``kind`` is a place in ``KINDS``; code points, the end is exclusive. NULL and empty texts have
    no span; a NULL doc_id stays; repeated rows get equal spans; other columns are ignored. Without
    candidates nothing is trained. Base spans are always there.
    """
    rows = found(docs)
    return rows.select("doc_id", "text_key", kept(F.col("found"), accepted(rows)).alias("spans"))


_KEPT = "array<struct<start:int,kind:int,end:int,base:boolean>>"


def written(found: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans leave no gap.

    Each chunk of spans takes its part of the text, and each span its piece of that part.
    """
    name = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    reach = lambda xs, upto: F.aggregate(F.slice(xs, F.lit(1), upto), F.lit(0), lambda a, x: F.greatest(a, x["end"]))

    def part(xs: Column, low: Column, own: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            return _let(F.greatest(low, reach(xs, i)), lambda r: F.concat(F.substring(own, r - low + 1, F.greatest(x["start"] - r, F.lit(0))), F.get(name, x["kind"])))

        return F.array_join(F.transform(xs, piece), "")

    def replaced(xs: Column) -> Column:
        def chunk(c: Column, ends: Column) -> Column:
            # up to the last start in the chunk, from where all chunks before it end
            low = F.greatest(F.lit(0), F.coalesce(F.array_max(F.slice(ends, F.lit(1), c)), F.lit(0)))
            return _let(
                F.struct(F.slice(xs, c * CHUNK + 1, CHUNK).alias("items"), low.alias("low")),
                lambda y: _let(F.substring(text, y["low"] + 1, F.greatest(F.array_max(y["items"]["start"]) - y["low"], F.lit(0))), lambda own: part(y["items"], y["low"], own)),
            )

        ends = F.transform(_chunks(xs), lambda c: F.array_max(F.slice(xs, c * CHUNK + 1, CHUNK)["end"]))
        whole = _let(ends, lambda es: F.array_join(F.transform(_chunks(xs), lambda c: chunk(c, es)), ""))
        tail = _let(F.array_max(xs["end"]), lambda r: F.substring(text, r + 1, F.char_length(text)))
        return F.when(F.size(xs) == 0, text).otherwise(F.concat(whole, tail))

    return _let(found, replaced)
