"""Personal data in whole texts: fixed base rules, and spans that boosted trees pick from loose candidates.

DataFrame operations only. Candidates and their features are made row by row, so a document is never shuffled; only
distinct feature values are gathered, for training and for the thresholds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm import boosting
from arrears_mart.llm.columns import count_below, let, scan
from arrears_mart.stages import stage_table

#: Fixed by the contract: kinds in order with the pattern of each.
BASE = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+",
    "ip": "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
    "card": "[0-9]([\\x20-]?[0-9])+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
KINDS = list(BASE)
#: The same matches without repeated groups, which in long texts would exhaust the stack: first a separator that cannot
#: be part of a match is replaced by one sign, then character classes suffice. Starts inside a run that failed at its
#: own start are not tried, so a long run costs one pass.
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_CLEARED = {
    "email": f"(?<![{_LABEL}])\\.|\\.(?![{_LABEL}])",
    "card": "(?<![0-9])[\\x20-]|[\\x20-](?![0-9])",
}
_FLAT = {
    "email": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\\.[{_LABEL}.]++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9][0-9\\x20-]++",
    "phone": BASE["phone"],
}
#: What a text must hold for the pattern to be tried.
_NEEDED = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
#: Loose patterns that propose candidates, each for the kinds it may hold; the candidates overlap. A proposal must have
#: so many digits at least, which keeps counts and years out.
PROPOSALS = (
    (("email",), "@", "[^\\x00-\\x20<>\"',;()@]++@[^\\x00-\\x20<>\"',;()@]++", 0),
    (("email",), " (?:at|\\(at\\)|\\[at\\]) ", "[A-Za-z0-9._%+-]{1,64} (?:at|\\(at\\)|\\[at\\]) [A-Za-z0-9-]++(?: (?:dot|\\(dot\\)|\\[dot\\]) [A-Za-z0-9-]++){1,4}", 0),
    (("ip",), "[0-9]\\.[0-9]", "(?<![0-9.])[0-9]++\\.[0-9][0-9.]*+", 4),
    (("card", "phone"), "[0-9][ ().-]*[0-9][ ().-]*[0-9]", "[+(]?[0-9][0-9 ().-]*[0-9]", 7),
    (("secret",), "[A-Za-z0-9+/_-]{20}", "[A-Za-z0-9+/_-]{20,}+", 4),
)
#: Kinds that only the method finds, after those of the rules, and what stands before one whose text says what it is.
EVERY_KIND = [*KINDS, "secret"]
_ASSIGNED = "(?i)(?:token|secret|key|password|passwd|pwd|auth)[\"' ]*[:=][\"' ]*$"
FEATURES = ("kind", "digits", "length", "letters", "dots", "gaps", "groups", "plus", "bracket", "at", "cue", "before", "after", "kinds_of_digit")
_CUE = "(?i)(mail|phone|tel|call|mobile|fax|contact|address|card|visa|iban|ip|host|server)[^A-Za-z]*$"
_CONTEXT = 16

Lambda = Callable[[Column], Column]


_MATCH = "struct<start:int,end:int,found:string,before:string,after:string>"


def _located(text: Column, needed: str, pattern: str, cleared: str | None = None) -> Column:
    """Array of (start, end, found, before, after): the leftmost matches, none overlapping; places are code points, and
    before and after are some characters on either side.

    Cutting a text at a pattern and taking the pattern out of it find the same matches, so the lengths of the pieces in
    turn give the places. What matches `cleared` becomes `_` before, one for one.
    """
    searched = F.regexp_replace(text, cleared, "_") if cleared else text
    empty = F.array().cast(f"array<{_MATCH}>")

    def located(whole: Column) -> Column:
        gaps = F.split(whole, pattern, -1)
        found = F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
        pieces = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found"), F.slice(gaps, 2, F.size(gaps)).alias("next")), lambda p: p["found"].isNotNull())

        def step(state: Column, p: Column) -> tuple[Column, Column]:
            start = state["at"] + F.length(p["gap"])
            end = start + F.length(p["found"])
            before = F.right(F.concat(state["last"], p["gap"]), F.lit(_CONTEXT))
            out = F.struct(
                start.alias("start"), end.alias("end"), p["found"].alias("found"), before.alias("before"), F.left(p["next"], F.lit(1)).alias("after")
            )
            return F.struct(end.alias("at"), F.right(p["found"], F.lit(_CONTEXT)).alias("last")), out

        return scan(pieces, F.struct(F.lit(0).alias("at"), F.lit("").alias("last")), step, _MATCH)

    return F.when(text.rlike(needed), let(searched, located)).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check of card numbers: from the right every second digit counts twice, as the sum of its own digits."""
    single = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            F.filter(single, lambda c: c != ""),
            lambda c, i: c.cast("int") * (1 + i % 2) - F.when((i % 2 == 1) & (c.cast("int") > 4), 9).otherwise(0),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )
    return total % 10 == 0


def _small_parts(address: Column) -> Column:
    """Whether each part of a dotted address is at most 255."""
    significant = lambda p: F.regexp_replace(p, "^0+", "")
    fits = lambda p: (F.length(significant(p)) < 3) | ((F.length(significant(p)) == 3) & (significant(p) <= "255"))
    return F.forall(F.split(address, "\\."), fits)


def _valid(kind: str) -> Lambda:
    count = lambda m: F.length(_digits(m["found"]))
    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: _small_parts(m["found"]),
        "card": lambda m: F.when(count(m).between(13, 19), _luhn(_digits(m["found"]))).otherwise(False),
        "phone": lambda m: count(m).between(9, 15),
    }[kind]


def _base_spans(text: Column) -> Column:
    """Array of (kind, start, end) that the base rules find; kind is its place in KINDS."""

    def of(i: int, kind: str) -> Column:
        kept = F.filter(_located(text, _NEEDED[kind], _FLAT[kind], _CLEARED.get(kind)), _valid(kind))
        return F.transform(kept, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    return F.sort_array(F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)]))


def _shape(body: Column) -> dict[str, Column]:
    """The features that a candidate's own text gives."""
    digits = _digits(body)
    holds = lambda c: F.instr(body, c).cast("boolean").cast("int")
    less = lambda n, most: F.least(n, F.lit(most))
    return {
        "digits": less(F.length(digits), 24),
        "length": less(F.length(body), 40),
        "letters": less(F.length(F.regexp_replace(body, "[^A-Za-z]", "")), 20),
        "dots": less(F.length(F.regexp_replace(body, "[^.]", "")), 6),
        "gaps": less(F.length(F.regexp_replace(body, "[^ -]", "")), 8),
        "groups": less(F.size(F.split(body, "[^0-9]+")), 8),
        "plus": holds("+"),
        "bracket": holds("("),
        "at": holds("@"),
        "kinds_of_digit": F.size(F.array_distinct(F.filter(F.split(digits, ""), lambda c: c != ""))),
    }


def _candidate(kind: int, found: Column) -> Column:
    """A candidate as a struct with its features; the rules' own checks are not among them.

    `plausible` is 0 for what cannot be of the kind, however it is written: the parts or the number of digits are wrong, or
    a secret is a plain word or number. A check digit may be mistyped. `told` is 1 for a secret whose text names it.
    """
    body, before, after = found["found"], found["before"], found["after"]
    kind_of = lambda c: F.when(c == "", 0).when(c.rlike("[\\s]"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike("[A-Za-z]"), 3).otherwise(4)
    features = {
        "kind": F.lit(kind),
        **_shape(body),
        "cue": before.rlike(_CUE).cast("int"),
        "before": kind_of(F.right(before, F.lit(1))),
        "after": kind_of(after),
    }
    plausible = {
        "email": lambda: F.lit(True),
        "ip": lambda: body.rlike("^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$") & _valid("ip")(found),
        "card": lambda: F.length(_digits(body)).between(13, 19),
        "phone": lambda: F.length(_digits(body)) <= 15,
        "secret": lambda: body.rlike("[A-Za-z]") & (F.length(body) < 200),
    }[EVERY_KIND[kind]]()
    told = before.rlike(_ASSIGNED) if EVERY_KIND[kind] == "secret" else F.lit(False)
    return F.struct(
        found["start"].alias("start"),
        found["end"].alias("end"),
        body.alias("body"),
        plausible.cast("int").alias("plausible"),
        (told & plausible).cast("int").alias("told"),
        *[features[n].cast("int").alias(n) for n in FEATURES],
    )


def _rewritten(c: Column) -> Column:
    """Array of other ways to write a confirmed candidate, without the sign that the rules go by: phones without `+`,
    e-mails with `at` and `dot`, cards with a mistyped last digit or other separators, secrets that nothing names (the
    same text; their place is what differs). The addresses proposed have no other way."""
    body = c["body"]
    local = F.regexp_extract(body, f"([{_LOCAL}]+)@", 1)
    domain = F.regexp_extract(body, f"@([{_LABEL}][{_LABEL}.]*[{_LABEL}])", 1)
    mail = lambda at, dot: F.concat(local, F.lit(f" {at} "), F.regexp_replace(domain, "\\.", f" {dot} "))
    fours = lambda gap: F.regexp_replace(_digits(body), "([0-9]{4})(?=[0-9])", f"$1{gap}")
    none = F.array().cast("array<string>")
    return (
        F.when(c["kind"] == EVERY_KIND.index("email"), F.array(mail("at", "dot"), mail("(at)", "(dot)"), mail("[at]", "[dot]")))
        .when(c["kind"] == EVERY_KIND.index("card"), F.array(body, fours("."), fours("  ")))
        .when(c["kind"] == EVERY_KIND.index("phone"), F.array(F.regexp_replace(body, "\\+", "")))
        .when(c["kind"] == EVERY_KIND.index("secret"), F.array(body))
        .otherwise(none)
    )


def _candidates(text: Column) -> Column:
    """Array of candidates; `proposal` tells which pattern and kind gave one, and those of one do not overlap."""

    def of(number: int, kind: str, needed: str, pattern: str, least: int) -> Column:
        enough = F.filter(_located(text, needed, pattern), lambda m: F.length(_digits(m["found"])) >= least)
        return F.transform(enough, lambda m: _candidate(EVERY_KIND.index(kind), m).withField("proposal", F.lit(number)))

    listed = [(kind, *rest) for kinds, *rest in PROPOSALS for kind in kinds]
    return F.concat(*[of(i, *one) for i, one in enumerate(listed)])


_PROPOSED = sum(len(kinds) for kinds, *_ in PROPOSALS)


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _with(spans: str, name: str, value: int) -> Column:
    return F.filter(spans, lambda s: s[name] == value)


_FEW = 16  # so many spans are looked at one by one
_REACH = "struct<start:int,end:int>"


def _reaching(spans: Column) -> Column:
    """(start, end) of spans in order of their starts, each end being the greatest so far."""
    step = lambda reach, s: (F.greatest(reach, s["end"]), F.struct(s["start"].alias("start"), F.greatest(reach, s["end"]).alias("end")))
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.when(F.size(spans) > _FEW, scan(ordered, F.lit(0), step, _REACH)).otherwise(ordered)


def _met(spans: Column, c: Column) -> Column:
    """Whether a candidate meets any of these spans (`_reaching`): among those that start before its end, one reaches past
    its start."""
    last = F.get(spans, count_below(spans, lambda s: s["start"] < c["end"]) - 1)
    many = F.coalesce(last["end"] > c["start"], F.lit(False))
    return F.when(F.size(spans) > _FEW, many).otherwise(F.exists(spans, lambda s: _overlaps(s, c)))


def find_spans(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` with _base and _candidates; a candidate that meets no base span of any kind is marked `free`, and one that a
    base span of its kind or its own text confirms `found`."""
    whole = F.coalesce(text, F.lit(""))
    based = rows.withColumns({"_base": _base_spans(whole), "_loose": _candidates(whole)})
    lists = F.array(*[_reaching(_with("_base", "kind", i)) for i in range(len(KINDS))], _reaching(F.col("_base")))

    def marked(known: Column) -> Column:
        def mark(c: Column) -> Column:
            own = F.when(c["kind"] < len(KINDS), _met(F.get(known, c["kind"]), c)).otherwise(c["told"] == 1)
            return c.withField("found", own.cast("int")).withField("free", ~_met(F.get(known, F.lit(len(KINDS))), c))

        return F.transform("_loose", mark)

    return based.withColumn("_candidates", F.when(F.size("_loose") > 0, let(lists, marked)).otherwise(F.transform("_loose", _unmet))).drop("_loose")


def _unmet(c: Column) -> Column:
    return c.withField("found", c["told"]).withField("free", F.lit(True))


#: What is known of a candidate: confirmed by the base rules, in the place of a base span of another kind, or nothing; from
#: REWRITTEN on, the ways of writing a confirmed one in turn. Implausible ones are never added and do not train.
CONFIRMED, OTHER, UNKNOWN, REWRITTEN = range(4)


def _known(found: DataFrame) -> DataFrame:
    """Stored distinct feature values with `role` (see above) and `n`, their number."""
    role = lambda c: F.when(c["found"] == 1, CONFIRMED).when(c["free"], UNKNOWN).otherwise(OTHER)
    row = lambda c, shape, r: F.struct(*[shape.get(n, c[n]).cast("int").alias(n) for n in FEATURES], r.cast("int").alias("role"))
    # A secret that is written another way stands between blanks, and nothing names it.
    bare = {"cue": 0, "before": 1, "after": 1}
    unnamed = lambda c: {n: F.when(c["kind"] == EVERY_KIND.index("secret"), v).otherwise(c[n]) for n, v in bare.items()}
    again = F.flatten(
        F.transform(
            F.filter("_candidates", lambda c: c["found"] == 1),
            lambda c: F.transform(_rewritten(c), lambda body, i: row(c, _shape(body) | unnamed(c), i + REWRITTEN)),
        )
    )
    usable = F.filter("_candidates", lambda c: (c["found"] == 1) | (c["plausible"] == 1))
    each = F.concat(F.transform(usable, lambda c: row(c, {}, role(c))), again)
    each = found.select(F.explode(each).alias("c")).select("c.*")
    return stage_table(each.groupBy(*FEATURES, "role").agg(F.count(F.lit(1)).alias("n")), "pii-candidates")


def fit(found: DataFrame, precision: float = 0.9) -> tuple[boosting.Trees, list[float]]:
    """Trees and a threshold for each kind, from positive and unlabelled candidates.

    Positive are confirmed candidates and these written another way; the unknown ones stand against them, together at
    most as heavy as the positive ones of their kind, and those in the place of another kind. Unknown ones may well be
    positive, so a score is judged by what rewritten ones get: on average c, which is the share of the positive ones that
    are known as such, so that score / c estimates the probability (Elkan and Noto). c is the least of all ways of writing,
    as the unknown ones may all be written one way. The threshold of a kind is `precision` * c; of the known candidates
    from there on at least `precision` must be of the kind, or it is raised, which is judged by the feature values whose
    hash is divisible by 5 and that do not train (by all, if none of these is rewritten). Kinds that nothing is known of
    or that have no other way of writing have nothing added.
    """
    table = _known(found)
    weights = {kind: 1.0 for kind in range(len(EVERY_KIND))}
    rewritten, unknown = F.col("role") >= REWRITTEN, F.col("role") == UNKNOWN
    positive = rewritten | (F.col("role") == CONFIRMED)
    aside = F.pmod(F.xxhash64(*FEATURES), F.lit(5)) == 0
    for r in table.where(~aside).groupBy("kind").agg(F.sum(F.when(positive, F.col("n"))).alias("p"), F.sum(F.when(unknown, F.col("n"))).alias("u")).collect():
        if r.p and r.u:
            weights[r.kind] = min(1.0, r.p / r.u)
    weight = F.col("n") * F.when(unknown, F.get(F.array(*map(F.lit, weights.values())), F.col("kind"))).otherwise(1.0)
    model = boosting.fit(table.where(~aside).withColumns({"_label": positive.cast("int"), "_weight": weight}), FEATURES, "_label", weight="_weight")
    score = model.probability()
    known = table.where(rewritten | (F.col("role") == OTHER))
    ways = known.where(rewritten).groupBy("kind", "role").agg((F.sum(score * F.col("n")) / F.sum("n")).alias("c"))
    expected: dict[int, float] = {}
    for r in ways.collect():
        expected[r.kind] = min(r.c, expected.get(r.kind, 1.0))
    step = F.floor(score * 100).cast("int").alias("step")
    good = F.sum(F.when(rewritten, F.col("n")).otherwise(0)).alias("good")
    judged = known.groupBy("kind", aside.alias("aside"), step).agg(good, F.sum("n").alias("n")).collect()  # at most 202 a kind
    thresholds = [2.0] * len(EVERY_KIND)
    for kind, c in expected.items():
        own = [r for r in judged if r.kind == kind]
        if any(r.good for r in own if r.aside):
            own = [r for r in own if r.aside]
        right = n = 0
        for at in sorted({r.step for r in own}, reverse=True):
            right, n = right + sum(r.good for r in own if r.step == at), n + sum(r.n for r in own if r.step == at)
            if right >= precision * n:
                thresholds[kind] = max(at / 100, precision * c)
        if right >= precision * n:  # no known one speaks against any score
            thresholds[kind] = precision * c
    return model, thresholds


def _texts_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, EVERY_KIND))
    return F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))


def detect(docs: DataFrame, precision: float = 0.9, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, base and spans, arrays of (kind, start, end) in order, kind by its place in EVERY_KIND.

    All base spans stay. A free and plausible candidate is added if its score reaches its kind's threshold and it overlaps
    no other such candidate of greater score (equal scores: the one that starts first, then the longer one, then the kind
    listed first). Null and empty texts have no spans; rows are judged apart, so repeated rows and null ids are like any
    other. Long texts are read whole, in time that grows with their matches and not with the square of them. Without
    documents, or if nothing is confirmed, nothing is added. Other columns are not read. Base spans and candidates are
    found once and stored; with `with_text`, for `redacted`, the texts are stored with them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = find_spans(rows, F.col("text")).select("doc_id", *(["text"] if with_text else []), "_base", "_candidates")
    found = stage_table(found, "pii-found")
    model, thresholds = fit(found, precision)
    limits = F.array(*map(F.lit, thresholds))

    def scored(c: Column) -> Column:
        score = model.probability(lambda f: c[f])
        return F.struct(
            (-score).alias("score"), c["start"].alias("start"), (-c["end"]).alias("back"), c["kind"].alias("kind"), c["end"].alias("end"), c["proposal"].alias("proposal")
        )

    free = F.filter(F.transform(F.filter("_candidates", lambda c: c["free"] & (c["plausible"] == 1)), scored), lambda s: -s["score"] >= F.get(limits, s["kind"]))

    def best(lists: Column) -> Column:
        """Those that no better one overlaps; what a proposal gave stands in order, so only neighbours are looked at."""

        def beaten(s: Column, i: int) -> Column:
            own = F.get(lists, F.lit(i))
            low = count_below(own, lambda o: o["end"] <= s["start"])
            high = count_below(own, lambda o: o["start"] < s["end"])
            near = F.slice(own, low + 1, F.greatest(high - low, F.lit(0)))
            return F.exists(near, lambda o: (o < s) & _overlaps(o, s))

        any_beats = lambda s: F.exists(F.array(*[beaten(s, i) for i in range(_PROPOSED)]), lambda x: x)
        return F.filter(F.flatten(lists), lambda s: ~any_beats(s))

    by_proposal = F.array(*[_with("_free", "proposal", i) for i in range(_PROPOSED)])
    chosen = F.when(F.size("_free") > 0, let(by_proposal, best)).otherwise(F.array().cast(FREE))
    added = F.transform(chosen, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    judged = found.withColumn("_free", free)
    names = [c for c in judged.columns if not c.startswith("_")]
    return judged.select(*names, F.col("_base").alias("base"), F.sort_array(F.concat("_base", added)).alias("spans"))


FREE = "array<struct<score:double,start:int,back:int,kind:int,end:int,proposal:int>>"


def digest(found: DataFrame) -> DataFrame:
    """Counts and texts of the spans that `detect` gives. Secrets, which the rules know nothing of, stand apart."""
    of = lambda i: F.filter("base", lambda s: s["kind"] == i)
    counts = [F.size(of(i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    base = F.sha2(F.concat_ws(",", _texts_of(F.col("base"))), 256).alias("base_sha256")
    personal, secret = F.filter("spans", lambda s: s["kind"] < len(KINDS)), F.filter("spans", lambda s: s["kind"] >= len(KINDS))
    texts = [F.concat_ws(",", _texts_of(c)).alias(n) for c, n in ((personal, "spans"), (secret, "secrets"))]
    return found.select("doc_id", *counts, base, *texts, F.size(secret).cast("long").alias("n_secret"))


def redacted(found: DataFrame) -> DataFrame:
    """(doc_id, text) with each span replaced by its kind in brackets; of spans that overlap the first one counts. `found` is
    `detect` with its texts; a null text is an empty one."""
    names = F.array(*map(F.lit, EVERY_KIND))
    whole = F.coalesce(F.col("text"), F.lit(""))
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def written(signs: Column) -> Column:
        between = lambda low, high: F.array_join(F.slice(signs, low + 1, F.greatest(high - low, F.lit(0))), "")

        def step(at: Column, s: Column) -> tuple[Column, Column]:
            piece = F.concat(between(at, s["start"]), F.lit("["), F.get(names, s["kind"]), F.lit("]"))
            return F.greatest(at, F.when(s["start"] >= at, s["end"]).otherwise(at)), F.when(s["start"] >= at, piece).otherwise("")

        last = lambda pieces: F.concat(F.array_join(pieces, ""), between(reach(ordered), F.size(signs)))
        return let(scan(ordered, F.lit(0), step, "string"), last)

    def reach(spans: Column) -> Column:
        """The end of the last span that counts."""
        return F.aggregate(spans, F.lit(0), lambda at, s: F.when(s["start"] >= at, s["end"]).otherwise(at))

    signs = F.split(whole, "")
    text = F.when(F.size("spans") > 0, let(signs, written)).otherwise(whole)
    return found.select("doc_id", text.alias("text"))
