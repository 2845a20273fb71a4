"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (e-mail addresses, IP addresses, card numbers, international phone numbers)
follow fixed patterns and always stay.  Looser patterns give further candidates: local
phone numbers, national ids, long numbers, spelled-out e-mail addresses and secrets
(keys, tokens, passwords).  Four labelers vote yes, no or abstain on every candidate: a
check of its form, a gazetteer (domain endings, issuer and key prefixes, service numbers),
the words before it, and what it stands between.

Expectation maximisation estimates, for each kind on its own, how common personal data
is among the candidates and each labeler's rates, from the counts of vote patterns of
all documents and without labels.  The rates start from ``START``, which also counts as
``STRENGTH`` candidates, a constant: in a large corpus the data decide, and a labeler that
is mostly wrong gets rates that say so.  What personal data is is fixed by two anchors: the
words before keep their rates, and the prior's odds stay within ``PRIOR_RANGE`` of their
start.  So a flood of candidates without words for or against can't turn the classes round;
one that other labelers reject does make their yes weigh more.

The posteriors are the soft labels of the final span classifier, a naive Bayes model of
each kind: its votes weigh as EM found, and features that no labeler votes with (length,
marks, neighbours, the words after it) add their smoothed log ratios, at ``SHARE``.  A
candidate that it finds likelier than not becomes a span.

DataFrame and SQL functions only: patterns run in the JVM, spans are arrays of structs,
EM is one expression over a kind's table of vote patterns (at most 3 ** 4).  The driver
gets the classifier's weights, bounded by the kinds' votes and bins.

The patterns are written with possessive parts and start conditions that don't
change what they match but keep them linear on long runs.

Cases: a null or empty text has no spans.  Spans of one kind never overlap; a
candidate that overlaps a base span is dropped.  Repeated rows give repeated rows, an
empty table an empty one.  Without any candidate the classifier adds nothing.  Columns
pass through ``redact`` under any name but one that starts with ``__pii_``, as internal
names do; ``personal_data`` reads the id alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import shared

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("phone_local", "national_id", "long_number", "email_spelled", "secret")
KINDS = BASE_KINDS + MORE_KINDS
EM_ROUNDS = 25
STRENGTH, SHARE, SMOOTH = 50.0, 0.5, 20.0
#: The labeler (words before) whose rates stay those of ``START``, so that the others can't swap the two classes' names.
ANCHOR = 2
#: A kind's prior odds stay within this factor of those of ``START``.
PRIOR_RANGE = 9.0

#: Fixed patterns of the base kinds.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = r"(?<![0-9+.-])(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])|(?<![0-9+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9])[0-9](?:[\x20.-]?+[0-9]){12,}+"
SPELLED = r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]{1,63})+"
#: Runs of 20 characters or more with a digit and a letter.
SECRET = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=-]{20})(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{20,}+"
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": ("@",), "ip": (".",), "phone": ("+",), "spelled": ("dot)", "dot]")}

#: Fixed word lists and patterns of the labelers.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "ch", "at", "nl")
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
SERVICE = r"^([0-9]11|[0-9]{3}[0-9]11|800|888|877|866|900)"
ID_RANGES = r"^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
SPECIMENS = ("078051120", "219099999", "457555462", "123456789")
KEY_PREFIX = r"^(sk[-_]|pk[-_]|gh[pousr]_|AKIA|ASIA|xox[abps]-|eyJ|AIza|glpat-)"
UNIQUE_ID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
CONTEXT = {
    "phone_local": r"\b(phone|call|tel|mobile|cell|fax|contact|dial|ring|ruf|appel|llam)",
    "national_id": r"\b(ssn|social|security|passport|identity|national|ausweis|dni|taxpayer)",
    "long_number": r"\b(card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta|iban|account|konto|compte|cuenta)",
    "email_spelled": r"\b(e?-?mail|contact|write|reach|escri|schreib|kontakt)",
    "secret": r"\b(token|secret|key|api|passw|pwd|credential|auth|bearer|login)",
}
AGAINST = r"\b(sha|hash|md5|commit|checksum|digest|isbn|issn|order|invoice|version|serial|sku|ref|ticket|model|part|item|page|doi|uuid|guid|example|sample)"
#: A kind's prior, and each labeler's rate of yes for personal data and for other candidates, before EM: form, gazetteer, words before, neighbours.
START = {
    "phone_local": (0.3, 0.9, 0.6, 0.9, 0.6, 0.95, 0.05, 0.95, 0.7),
    "national_id": (0.3, 0.99, 0.7, 0.9, 0.7, 0.95, 0.05, 0.95, 0.7),
    "long_number": (0.3, 0.998, 0.1, 0.9, 0.4, 0.95, 0.05, 0.95, 0.7),
    "email_spelled": (0.5, 0.9, 0.5, 0.9, 0.3, 0.95, 0.2, 0.95, 0.7),
    "secret": (0.2, 0.9, 0.4, 0.95, 0.2, 0.95, 0.05, 0.9, 0.4),
}

NONE = "cast(array() as array<string>)"
EMPTY = "cast(array() as array<struct<s:int,e:int,m:string>>)"


def _spans(text: Column, found: Column, pattern: str) -> Column:
    """Arrays of (s, e, m): start, end (code points, exclusive) and match of each leftmost match in ``found``.

    Matches and the pieces before them alternate, so starts are running sums of lengths.
    """
    pairs = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("piece"))
    first = F.struct(F.lit(0).alias("at"), F.expr(EMPTY).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        m, start = pair["m"], acc["at"] + F.length(pair["piece"])
        span = F.struct(start.alias("s"), (start + F.length(m)).alias("e"), m.alias("m"))
        more = F.struct((start + F.length(m)).alias("at"), F.array_append(acc["out"], span).alias("out"))
        return F.when(m.isNull(), acc).otherwise(more)  # the piece after the last match

    return F.when(F.size(found) > 0, F.aggregate(pairs, first, step, lambda acc: acc["out"])).otherwise(F.expr(EMPTY))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        x = F.when(i % 2 == 0, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
        return total + x

    return (F.length(digits) > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0)


def _valid(kind: str, span: Column) -> Column:
    m = span["m"]
    size = F.length(_digits(m))
    if kind == "ip":
        parts = F.split(m, r"\.")
        return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(parts, lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
    if kind == "card":
        return size.between(16, 19) & luhn(_digits(m))
    if kind == "phone":
        return size.between(8, 15)
    return F.lit(True)


def _filtered(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: _valid(kind, x))


def _loose_kind(m: Column) -> Column:
    size = F.length(_digits(m))
    return F.when(size == 9, "national_id").when(size == 10, "phone_local").otherwise("long_number")


def _named(spans: str | Column, kind) -> Column:
    return F.transform(spans, lambda x: F.struct((kind(x["m"]) if callable(kind) else F.lit(kind)).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds __pii_base (kind, s, e of all base spans) and __pii_more (kind, s, e, features of the other candidates)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    patterns = PATTERNS | {"loose": LOOSE, "spelled": SPELLED, "secret": SECRET}

    def found(kind: str) -> Column:
        all_of = F.regexp_extract_all(t, F.lit(patterns[kind]), F.lit(0))
        tried = [F.contains(t, F.lit(x)) for x in NEEDS.get(kind, ())]
        return all_of if not tried else F.when(tried[0] | tried[-1], all_of).otherwise(F.expr(NONE))

    out = docs.withColumns({f"__pii_{k}": found(k) for k in patterns})
    out = out.withColumns({f"__pii_{k}": _spans(t, F.col(f"__pii_{k}"), p) for k, p in patterns.items()})
    base = F.concat(*[_named(_filtered(f"__pii_{k}", k), k) for k in BASE_KINDS])
    more = F.concat(_named("__pii_loose", _loose_kind), _named("__pii_spelled", "email_spelled"), _named("__pii_secret", "secret"))
    out = out.withColumns({"__pii_base": base, "__pii_more": more}).drop(*[f"__pii_{k}" for k in patterns])
    apart = F.filter("__pii_more", lambda x: ~F.exists("__pii_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    judged = F.transform(F.transform(apart, lambda x: _seen(t, x)), _judged)
    plain = F.transform("__pii_base", lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return out.withColumns({"__pii_base": plain, "__pii_more": F.when(F.size("__pii_more") > 0, judged).otherwise(F.expr("cast(array() as array<struct<kind:string,s:int,e:int,features:array<string>>>)"))})


def _seen(text: Column, x: Column) -> Column:
    """A candidate with its digits, the words around it and its neighbours."""
    near = F.lower(F.substring(text, F.greatest(x["s"] - 47, F.lit(1)), F.least(x["s"], F.lit(48))))
    after = F.lower(F.substring(text, x["e"] + 1, F.lit(32)))
    return F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), _digits(x["m"]).alias("digits"), near.alias("near"), after.alias("after"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("y")).when(no, F.lit("n")).otherwise(F.lit("-"))


def _by_kind(kind: Column, **of: Column) -> Column:
    out = F.lit(None)
    for k, v in of.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def _judged(x: Column) -> Column:
    """A candidate of ``_seen`` with its votes and other features."""
    kind, m, digits, near, after = (x[c] for c in ("kind", "m", "digits", "near", "after"))
    left, right = F.right(near, F.lit(1)), F.left(after, F.lit(1))
    form = _by_kind(kind, phone_local=digits.rlike("^[2-9][0-9]{2}[0-9]{7}$"), national_id=digits.rlike(ID_RANGES), long_number=luhn(digits) & (F.length(digits) <= 19), email_spelled=m.rlike(r"[A-Za-z]{2,}$"), secret=F.size(F.array_distinct(F.split(m, ""))) >= 10)
    known = _by_kind(kind, phone_local=~digits.rlike(SERVICE), national_id=~digits.isin(*SPECIMENS), long_number=digits.rlike(ISSUERS), email_spelled=F.lower(F.regexp_extract(m, "([A-Za-z0-9-]+)$", 1)).isin(*ENDINGS), secret=F.when(m.rlike(KEY_PREFIX), True).when(m.rlike(UNIQUE_ID), False))
    words = _by_kind(kind, **{k: near.rlike(p) for k, p in CONTEXT.items()})
    apart = ~left.rlike("[A-Za-z0-9]") & ~right.rlike("[A-Za-z0-9]")
    between = F.when(kind == "secret", near.rlike("[=:]\\s*[\"'`]?$")).otherwise(apart)
    votes = [_vote(form, ~form), _vote(known, ~known), _vote(words, near.rlike(AGAINST)), _vote(between, ~between)]
    beyond = _vote(_by_kind(kind, **{k: after.rlike(p) for k, p in CONTEXT.items()}), after.rlike(AGAINST))
    side = lambda c: F.when(c == "", "edge").when(c.rlike(r"\s"), "space").when(c.rlike("[A-Za-z0-9]"), "word").otherwise("mark")
    marks = F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(4))
    other = {"after": beyond, "left": side(left), "right": side(right), "marks": marks, "length": F.least(F.floor(F.length(m) / 4), F.lit(10))}
    features = F.array(*[F.concat(F.lit(f"v{l}="), v) for l, v in enumerate(votes)], *[F.concat(F.lit(f"{k}="), v) for k, v in other.items()])
    return F.struct(kind.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), features.alias("features"))


def profile_of(found: DataFrame) -> DataFrame:
    """Counts of kinds with votes and features; bounded by their bins."""
    return found.select(F.explode("__pii_more").alias("c")).groupBy("c.kind", "c.features").agg(F.count(F.lit(1)).alias("n"))


def reliabilities(profile: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """kind, th: the kind's prior and the labelers' rates, as in ``START``, after EM over ``kind``, ``features``, ``n``."""
    votes = F.transform(F.slice("features", 1, 4), lambda f: F.right(f, F.lit(1)))
    patterns = profile.groupBy("kind", votes.alias("v")).agg(F.sum("n").cast("double").alias("n"))
    rows = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p"), F.sum("n").alias("total"))
    start = F.element_at(F.create_map(*[c for k in MORE_KINDS for c in (F.lit(k), F.array(*map(F.lit, START[k])))]), F.col("kind"))
    rows = rows.withColumn("start", start).withColumn("w", F.lit(STRENGTH))

    def ratio(l: int) -> str:
        yes, no = f"th[{1 + 2 * l}]", f"th[{2 + 2 * l}]"
        return f"CASE x.v[{l}] WHEN 'y' THEN ln({yes} / {no}) WHEN 'n' THEN ln((1 - {yes}) / (1 - {no})) ELSE 0D END"

    odds = " + ".join(["ln(th[0] / (1 - th[0]))", *map(ratio, range(4))])
    posterior = f"transform(p, x -> named_struct('v', x.v, 'n', x.n, 'q', 1 / (1 + exp(-({odds})))))"
    total = lambda value, where="true": f"aggregate(filter(po, y -> {where}), 0D, (a, y) -> a + {value})"
    bound = lambda factor: f"({factor} * start[0] / (1 - start[0] + {factor} * start[0]))"
    new = [f"least(greatest(({total('y.n * y.q')} + w * start[0]) / (total + w), {bound(1 / PRIOR_RANGE)}), {bound(PRIOR_RANGE)})"]
    for l in range(4):
        for q, k in (("y.q", 1 + 2 * l), ("(1 - y.q)", 2 + 2 * l)):
            if l == ANCHOR:
                new.append(f"start[{k}]")
                continue
            voted = f"y.v[{l}] <> '-'"
            new.append(f"({total(f'y.n * {q}', f"y.v[{l}] = 'y'")} + w * start[{k}]) / ({total(f'y.n * {q}', voted)} + w)")
    fitted = f"aggregate(sequence(1, {rounds}), start, (th, i) -> element_at(transform(array({posterior}), po -> array({', '.join(new)})), 1))"
    return rows.select("kind", F.expr(fitted).alias("th"))


def _score(kind: Column, features: Column, weights: dict[str, float]) -> Column:
    """The sum of a candidate's weights; a kind without any is out."""
    table = F.create_map(*[F.lit(v) for kv in sorted(weights.items()) for v in kv])
    of = lambda name: F.element_at(table, F.concat(kind, F.lit(":"), name))
    return F.aggregate(features, F.coalesce(of(F.lit("prior")), F.lit(-math.inf)), lambda a, f: a + F.coalesce(of(f), F.lit(0.0)))


def train(profile: DataFrame) -> dict[str, float]:
    """The classifier's weights by ``kind:feature``; those of the votes are EM's, ``kind:prior`` is the prior's log odds."""
    weights = {}
    for r in reliabilities(profile).collect():  # a row for each kind
        kind, th = r["kind"], r["th"]
        weights[f"{kind}:prior"] = math.log(th[0] / (1 - th[0]))
        for l in range(4):
            yes, no = th[1 + 2 * l], th[2 + 2 * l]
            weights |= {f"{kind}:v{l}=y": math.log(yes / no), f"{kind}:v{l}=n": math.log((1 - yes) / (1 - no))}
    if not weights:
        return {}
    q = 1 / (1 + F.exp(-_score(F.col("kind"), F.slice("features", 1, 4), weights)))
    soft = profile.withColumn("yes", F.col("n") * q).withColumn("no", F.col("n") * (1 - q))
    by_feature = soft.select("kind", F.explode(F.slice("features", 5, 100)).alias("feature"), "yes", "no").groupBy("kind", "feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    totals = soft.groupBy("kind").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    rate = lambda x: (F.col(x) + SMOOTH * (F.col("yes") + F.col("no")) / (F.col("all_yes") + F.col("all_no"))) / (F.col(f"all_{x}") + SMOOTH)
    rows = by_feature.join(totals, "kind").select("kind", "feature", (SHARE * F.log(rate("yes") / rate("no"))).alias("w"))
    return weights | {f"{r['kind']}:{r['feature']}": r["w"] for r in rows.collect()}  # bounded by the features' bins


def accepted(weights: dict[str, float]) -> Column:
    """All spans (kind, s, e) that stay: base ones, and those that the classifier finds likelier than not."""
    base = F.col("__pii_base")
    if not weights:
        return base
    added = F.filter("__pii_more", lambda x: _score(x["kind"], x["features"], weights) > 0)
    added = F.transform(added, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return F.when(F.size("__pii_more") > 0, F.concat(base, added)).otherwise(base)


def _of_kind(spans: str | Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def described(spans: str | Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    place = F.transform(spans, lambda x: F.struct(F.array_position(F.array(*map(F.lit, kinds)), x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    place = F.sort_array(F.filter(place, lambda x: x["k"] > 0))
    return F.array_join(F.transform(place, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(found: DataFrame, weights: dict[str, float], keep: str = "doc_id") -> DataFrame:
    """The id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_spans of every row of ``candidates``."""
    rows = found.select(keep, "__pii_base", accepted(weights).alias("__pii_spans"))
    counts = [F.size(_of_kind("__pii_base", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    digest = F.sha2(described("__pii_base", BASE_KINDS).cast("binary"), 256)
    return rows.select(keep, *counts, digest.alias("base_sha256"), described("__pii_spans", KINDS).alias("spans"), F.size("__pii_spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in angle brackets.

    The rows are written once with their candidates, so that the patterns run once.
    """
    found = shared.cut(candidates(docs, text), "pii-candidates")
    weights = train(shared.cut(profile_of(found), "pii-profile"))
    found = found.withColumn("__pii_spans", F.sort_array(F.transform(accepted(weights), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))))
    t = F.col(text)
    first = F.struct(F.lit(0).alias("at"), F.expr(NONE).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.substring(t, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        fresh = F.concat(acc["out"], F.array(piece, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    joined = F.aggregate("__pii_spans", first, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t))))
    return found.withColumn(text, F.when(F.size("__pii_spans") > 0, joined).otherwise(t)).select(docs.columns)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = shared.cut(candidates(docs).drop("text"), "pii-candidates")
    return personal_data(found, train(shared.cut(profile_of(found), "pii-profile")))
