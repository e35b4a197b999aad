"""Personal data by weak supervision.

Candidates are the matches of one pattern per kind (email, ip, card, phone)
and of a few looser patterns (spelled-out addresses, national phone numbers).
Labelers vote on each: the strict rule of its kind, a gazetteer (domain
endings, reserved networks, card issuers, country codes), the words before it
and what it touches.  Votes of the whole corpus are counted per pattern of
votes, a table bounded by the number of patterns.  Expectation-maximisation
over it estimates how reliable each labeler is and how likely each pattern is
personal data; with these as soft labels a logistic classifier of the span's
shape is trained per kind, to convergence and on counts, so that rare kinds and
shapes are learned whatever stands beside them.  A match that satisfies the
strict rule is always reported; another candidate is added if the classifier
and the votes agree on it.  How many candidates of a kind are personal data never
speaks for one of them, and a match of a base pattern that fails its rule needs
the words before it on its side.

Everything on rows is built-in column functions: a pattern's matches and the
gaps between them give the offsets, in code points.

Defined results: a null or empty text has no spans; a candidate that overlaps a
strict span of any kind, or an added span of its kind that starts before it, is
dropped; rows are judged one by one; other
columns are ignored (or kept, by ``mask``); with no candidates nothing is added.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeline.llm.decision_list import let
from lifeline.llm.tables import save

KINDS = ("email", "ip", "card", "phone")

#: One pattern per kind.  Possessive loops can't backtrack and a
#: run is entered only at its start, so time is linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns; a match is reported only if the votes say so.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: Cheap tests that a text holds a match at all.
_HINT = {
    "email": r"@|[\[(]at[\])]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]|[0-9]{3}[.-][0-9]{4}",
}

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Fixed values of the gazetteers.
_ENDINGS = r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|us|ch|at)$"
_RESERVED = r"^0*(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|^0*192\.0*168\.|^0*169\.0*254\."
_ISSUERS = r"^(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|6(?:011|5[0-9]{2})[0-9]{12}|3[0568][0-9]{12})$"
_COUNTRIES = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_CUES = {
    "email": r"(?i)(?:mail|contact|write|kontakt|courriel|correo)[^\n]{0,16}$",
    "ip": r"(?i)(?:\bip|host|server|address|client|adresse)[^\n]{0,16}$",
    "card": r"(?i)(?:card|visa|credit|payment|karte|carte|tarjeta)[^\n]{0,16}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|telefon|móvil)[^\n]{0,16}$",
}
_AGAINST = r"(?i)(?:version|order|invoice|isbn|token|serial|hash|\bid|\bno|\bv)[^\n]{0,8}$"
_NEAR = 32

#: The classifier and the votes must both say so at least this surely.
ADD_MIN = 0.95
EM_ROUNDS = 50
#: Weight of the classifier's pull to 0, in candidates.
DECAY = 1e-3
NEWTON_ROUNDS = 200


def _matches(text: Column, pattern: str) -> Column:
    """start, end (exclusive), value, the text before and the character after
    each match.  Offsets are sums over blocks of matches, not over all of them."""
    block = 128

    def build(p: Column) -> Column:
        step = F.zip_with(F.slice(p["gaps"], 1, F.size(p["found"])), p["found"], lambda g, m: F.length(g) + F.length(m))
        return let(F.struct(p["gaps"].alias("gaps"), p["found"].alias("found"), step.alias("step")), blocks)

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def blocks(p: Column) -> Column:
        n = F.floor((F.size(p["found"]) + block - 1) / block).cast("int")
        sums = F.transform(F.sequence(F.lit(0), n - 1), lambda b: total(F.slice(p["step"], b * block + 1, block)))
        return let(
            F.struct(p["gaps"].alias("gaps"), p["found"].alias("found"), p["step"].alias("step"), sums.alias("sums")), place
        )

    def place(p: Column) -> Column:
        def one(m: Column, k: Column) -> Column:
            b = F.floor(k / block).cast("int")
            before = total(F.slice(p["sums"], F.lit(1), b)) + total(F.slice(p["step"], b * block + 1, k % block))
            start = before + F.length(F.get(p["gaps"], k))
            return F.struct(
                start.cast("long").alias("start"),
                (start + F.length(m)).cast("long").alias("end"),
                m.alias("value"),
                F.right(F.get(p["gaps"], k), F.lit(_NEAR)).alias("before"),
                F.left(F.get(p["gaps"], k + 1), F.lit(1)).alias("after"),
            )

        return F.transform(p["found"], one)

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>")
    return let(parts, lambda p: F.when(F.size(p["found"]) == 0, empty).otherwise(build(p)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def strict(kind: str, value: Column) -> Column:
    """The rule that a match of the kind's base pattern has to satisfy."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        d = _digits(value)
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    return F.length(_digits(value)).between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


VOTES = ("rule", "gazetteer", "context", "edges")


def _votes(kind: str, s: Column, loose: bool) -> list[Column]:
    value, no = s["value"], F.lit(False)
    rule = F.lit(0) if loose else _vote(strict(kind, value), F.lit(True))
    known = {
        "email": _vote(value.rlike(_ENDINGS) | value.rlike(r"(?i)[\[(]dot[\])]"), F.lit(True)),
        "ip": _vote(no, value.rlike(_RESERVED)),
        "card": _vote(_digits(value).rlike(_ISSUERS), F.lit(True)),
        "phone": _vote(value.rlike(_COUNTRIES), value.startswith("+")),
    }[kind]
    context = _vote(s["before"].rlike(_CUES[kind]), s["before"].rlike(_AGAINST))
    edges = _vote(~(s["before"].rlike(r"[\p{L}0-9_]$") | s["after"].rlike(r"^[\p{L}0-9_]")), F.lit(True))
    return [c.cast("int").alias(n) for c, n in zip((rule, known, context, edges), VOTES, strict=True)]


SHAPES = ("size", "separated", "digits", "loose")


def _shapes(s: Column, loose: bool) -> list[Column]:
    """What the classifier sees of a span, in a few steps each."""
    n = F.length(s["value"])
    d = F.length(_digits(s["value"]))
    return [
        F.least(F.floor(n / 6), F.lit(4)).cast("int").alias("size"),
        s["value"].rlike(r"[\x20().-]").cast("int").alias("separated"),
        F.least(F.floor(d / 4), F.lit(5)).cast("int").alias("digits"),
        F.lit(int(loose)).alias("loose"),
    ]


def _dressed(kind: str, loose: bool):
    """A match as a candidate."""
    return lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), *_votes(kind, s, loose), *_shapes(s, loose)
    )


def candidates(text: Column) -> Column:
    """All candidates of a text: kind number, span, votes, shape."""
    text = F.coalesce(text, F.lit(""))
    out = []
    for kind in KINDS:
        found = F.transform(_matches(text, BASE[kind]), _dressed(kind, False))
        if kind in LOOSE:
            extra = F.transform(_matches(text, LOOSE[kind]), _dressed(kind, True))
            found = let(
                F.struct(found.alias("a"), extra.alias("b")),
                lambda p: F.concat(
                    p["a"],
                    F.filter(p["b"], lambda x: ~F.exists(F.filter(p["a"], lambda y: y["rule"] == 1), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))),
                ),
            )
        empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint," + ",".join(f"{c}:int" for c in VOTES + SHAPES) + ">>")
        out.append(F.when(text.rlike(_HINT[kind]), found).otherwise(empty))
    return F.concat(*out)


class Model:
    """Reliabilities of the labelers and the classifier's weights."""

    def __init__(self, counts: list[tuple[int, tuple[int, ...], tuple[int, ...], int]]):
        """``counts``: kind, votes, shape and the number of such candidates."""
        self.prior = {k: 0.5 for k in range(len(KINDS))}
        self.right = {(k, j): 0.8 for k in range(len(KINDS)) for j in range(len(VOTES))}
        for _ in range(EM_ROUNDS if counts else 0):
            self._maximise([(k, v, n, self.posterior(k, v)) for k, v, _, n in counts])
        self.weights: dict[tuple, float] = {}
        self._fit(counts)

    def _start(self, kind: int) -> float:
        """What a candidate's kind says before any vote: never that it is personal data."""
        p = min(max(self.prior[kind], 1e-6), 0.5)
        return math.log(p / (1 - p))

    def posterior(self, kind: int, votes: tuple[int, ...]) -> float:
        z = self._start(kind)
        for j, v in enumerate(votes):
            z += v * math.log(self.right[kind, j] / (1 - self.right[kind, j]))
        return _sigmoid(z)

    def _maximise(self, rows: list) -> None:
        for k in self.prior:
            own = [r for r in rows if r[0] == k]
            # a labeler starts from one right and a quarter wrong vote, so none becomes certain or is turned round
            self.prior[k] = (sum(n * p for *_, n, p in own) + 1) / (sum(n for *_, n, _ in own) + 2)
            for j in range(len(VOTES)):
                said = [(v[j], n, p) for _, v, n, p in own if v[j]]
                agree = sum(n * (p if v > 0 else 1 - p) for v, n, p in said)
                self.right[k, j] = min(max((agree + 8) / (sum(n for _, n, _ in said) + 10), 0.55), 0.99)

    @staticmethod
    def _names(kind: int, shape: tuple[int, ...]) -> list[tuple]:
        return [(kind,), *((kind, j, x) for j, x in enumerate(shape))]

    def _fit(self, counts: list) -> None:
        self.weights = {}
        for k in range(len(KINDS)):
            # candidates of a shape, and how many of them the votes call personal data
            shapes: dict[tuple[int, ...], list[float]] = {}
            for kind, v, s, n in counts:
                if kind == k:
                    own = shapes.setdefault(s, [0.0, 0.0])
                    own[0] += n
                    own[1] += n * self.posterior(k, v)
            if shapes:
                names = sorted({x for s in shapes for x in self._names(k, s)})
                x = np.array([[name in self._names(k, s) for name in names] for s in shapes], dtype=float)
                n, yes = np.array(list(shapes.values())).T
                self.weights |= zip(names, _logistic(x, n, yes).tolist(), strict=True)

    def agrees(self, c: Column) -> Column:
        """Both the votes and the classifier call candidate ``c`` personal data."""
        out = F.lit(False)
        for k in range(len(KINDS)):
            z = F.lit(self._start(k))
            for j, name in enumerate(VOTES):
                z = z + c[name] * F.lit(math.log(self.right[k, j] / (1 - self.right[k, j])))
            w = F.lit(self.weights.get((k,), 0.0))
            for j, name in enumerate(SHAPES):
                steps = sorted((key[2], x) for key, x in self.weights.items() if len(key) == 3 and key[:2] == (k, j))
                part = F.lit(0.0)
                for value, x in steps:
                    part = F.when(c[name] == value, F.lit(x)).otherwise(part)
                w = w + part
            bound = F.lit(math.log(ADD_MIN / (1 - ADD_MIN)))
            out = F.when(c["kind"] == k, (z >= bound) & (w >= bound)).otherwise(out)
        return out & ((c["rule"] >= 0) | (c["context"] == 1))


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _logistic(x: np.ndarray, n: np.ndarray, yes: np.ndarray) -> np.ndarray:
    """Weights of the features ``x`` by Newton steps, halved until they help."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(yes @ np.logaddexp(0, -z) + (n - yes) @ np.logaddexp(0, z) + DECAY / 2 * (w @ w))

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(NEWTON_ROUNDS):
        q = np.exp(-np.logaddexp(0, -(x @ w)))
        slope = x.T @ (yes - n * q) - DECAY * w
        bend = (x.T * (n * q * (1 - q))) @ x + DECAY * np.eye(len(w))
        # scaled, so that rare features count beside frequent ones; those that say the same share a step
        scale = 1 / np.sqrt(np.diag(bend))
        step = scale * np.linalg.lstsq(bend * np.outer(scale, scale), scale * slope, rcond=1e-12)[0]
        size = 1.0
        while (then := loss(w + size * step)) > now and size > 1e-9:
            size /= 2
        if then > now:
            break
        w, now = w + size * step, then
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def with_candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``candidates``; what ``fit`` and the spans take."""
    return docs.select(*keep, candidates(F.col("text")).alias("candidates"))


def fit(rows: DataFrame) -> Model:
    """Count vote and shape patterns over all ``candidates`` and fit the model;
    there are at most 4 * 81 * 180 patterns."""
    rows = rows.select(F.explode("candidates").alias("c")).groupBy("c.kind", *(f"c.{x}" for x in VOTES + SHAPES)).count().collect()
    v, s = len(VOTES), len(SHAPES)
    return Model(sorted((r[0], tuple(r[1 : 1 + v]), tuple(r[1 + v : 1 + v + s]), r["count"]) for r in rows))


def train(docs: DataFrame) -> Model:
    return fit(with_candidates(docs))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _apart(base: Column, added: Column) -> Column:
    """Of the spans ``added``, by start, those that overlap no strict span and no
    kept one of their kind."""
    free = F.filter(added, lambda x: ~F.exists(base, lambda y: _overlap(x, y)))
    by_start = F.transform(free, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind")))
    again = F.transform(F.sort_array(by_start), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (-x["back"]).alias("end")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    clash = lambda kept, x: F.exists(kept, lambda y: (y["kind"] == x["kind"]) & _overlap(x, y))
    return F.aggregate(again, none, lambda kept, x: F.when(clash(kept, x), kept).otherwise(F.concat(kept, F.array(x))))


def spans_of(rows: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``base`` and ``all_spans``: arrays of (kind, start, end), in order."""
    pick = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    both = F.struct(
        F.transform(F.filter("candidates", lambda c: c["rule"] == 1), pick).alias("base"),
        F.transform(F.filter("candidates", lambda c: (c["rule"] != 1) & model.agrees(c)), pick).alias("added"),
    )
    spans = let(
        both,
        lambda p: F.struct(
            p["base"].alias("base"),
            F.when(F.size(p["added"]) == 0, F.sort_array(p["base"]))
            .otherwise(F.sort_array(F.concat(p["base"], _apart(p["base"], p["added"]))))
            .alias("all_spans"),
        ),
    )
    return rows.select(*keep, spans.alias("__spans")).select(*keep, "__spans.base", "__spans.all_spans")


def found_spans(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    return spans_of(with_candidates(docs, *keep), model, *keep)


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, counts of strict spans per kind, base_sha256, spans).  Without a
    ``model`` one is fitted; candidates are then written once and read twice."""
    rows = with_candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    if model is None:
        rows = save(rows, "pii-candidates")
        model = fit(rows)
    rows = spans_of(rows, model, "doc_id")
    kinds = F.transform("base", lambda s: s["kind"])
    return rows.select(
        "doc_id",
        *((F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("all_spans")).alias("spans"),
    )


def mask(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, same columns;
    overlapping spans become one, named by the first."""

    def merged(spans: Column) -> Column:
        flat = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        first = F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>")

        def add(done: Column, s: Column) -> Column:
            last = F.get(done, F.size(done) - 1)
            joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
            return F.when(
                (F.size(done) > 0) & (s["start"] < last["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
            ).otherwise(F.concat(done, F.array(s)))

        return F.aggregate(flat, first, add)

    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def rebuilt(p: Column) -> Column:
        cut = lambda a, b: F.substring(p["text"], (a + 1).cast("int"), (b - a).cast("int"))
        parts = F.transform(
            p["m"],
            lambda s, k: F.concat(cut(F.when(k == 0, F.lit(0).cast("long")).otherwise(F.get(p["m"], k - 1)["end"]), s["start"]), F.get(names, s["kind"])),
        )
        tail = F.get(p["m"], F.size(p["m"]) - 1)["end"]
        return F.concat(F.array_join(parts, ""), cut(tail, F.length(p["text"]).cast("long")))

    rows = found_spans(docs.select(F.struct(*docs.columns).alias("__row"), "text"), model, "__row")
    text = F.col("__row.text")
    clean = F.when(F.size("all_spans") == 0, text).otherwise(
        let(F.struct(text.alias("text"), merged(F.col("all_spans")).alias("m")), rebuilt)
    )
    return rows.select(*(clean.alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns))
