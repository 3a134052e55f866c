"""Personal data, with information-theoretic sanitisation. DataFrame functions only.

Base spans are the matches of one pattern per kind. The patterns are written with possessive runs and start only where
a run of their characters starts (or the match before ended), which finds the same leftmost matches in
linear time. Positions follow from the lengths of the parts between matches and of the matches.

Terms of a text may give a value away even when the span is removed. Each distinct value is a protected entity, and so are
its coarser parts: the kind, the domain of an e-mail, the first digits of a phone or card number, the network of an ip. For
a term t and an entity e the corpus gives P(e) (texts with e, but FLOOR at least) and P(e|t) (texts with both out of those
with t), of which the lower Wilson bound at TRUST standard deviations counts: what a few texts show is trusted less than
what many do. The disclosure is 1 - log(bound) / log(P(e)), the part of the information of e that t reveals, and 0 where that
is negative. FLOOR makes it depend on the texts with t alone once an entity is rare, so the same evidence weighs the same
in a table of any size; one text is never enough for a claim. Terms are generalised from GENERALISE on and
removed from REMOVE on, at all their places in the documents with that entity. A value that occurs in one text is protected
through its parts, whose counts other values share. A term is a run of letters and digits of any length
outside the spans; in scripts written without blanks, each two signs in a row.

Equal texts count once: each row weighs one divided by the copies of its text. Entities of the same rows have the same counts
and are scored as one class. The bound lies below the plain share, and rises with the texts for one share: terms in too many texts
for an entity and terms or entities in too few cannot reach GENERALISE. They are left out before they are paired,
without a change to the result.

Of texts only those with spans are shuffled, with their row ids; counts are aggregated before each shuffle. Documents are
counted over the whole table.

Cases: a null or empty text has no spans. Repeated rows and rows without an id are documents of their own. Positions count code points, ends are
exclusive. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.llm.frames import table, texts
from echowire.operators.skew import attach
from echowire.session import stored

# The kinds in their order. The given patterns are quoted on the right.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 13 to 19 digits: such a run begins and ends where no longer one does
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)

#: Standard deviations between the share of texts with an entity and its lower bound.
TRUST = 1.645
#: Entities in a smaller share of texts are held to be this frequent.
FLOOR = 0.01
#: Repeated texts whose hashes may be broadcast; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
GENERALISE = 0.8
REMOVE = 0.95

# Scripts written without blanks
_OPEN = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\x{30FC}"
_WORD = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_OPEN}]]++"
# Two signs in a row from each even and each odd place of a run; a sign that stands alone is a term
_EVEN = rf"[{_OPEN}]{{2}}|(?<![{_OPEN}])[{_OPEN}](?![{_OPEN}])"
_ODD = rf"(?<=(?<![{_OPEN}])[{_OPEN}])[{_OPEN}]{{2}}|\G(?<=[{_OPEN}])[{_OPEN}]{{2}}"
_SPAN = "array<struct<start: int, end: int, value: string>>"
#: Elements that running sums are taken over at once.
_RUN = 256


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _before(values: Column, of: Callable[[Column], Column]) -> Column:
    """`of` (a sum or a maximum that takes 0 for nothing) of all elements before each one.

    Blocks keep the work near linear on very long arrays.
    """

    def within(held: Column) -> Column:
        at = lambda i: F.floor(i / _RUN).cast("int")
        part = lambda i: F.slice(held["v"], at(i) * _RUN + 1, i % _RUN)
        return F.transform(held["v"], lambda _, i: of(F.array(held["b"][at(i)], of(part(i)))))

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / _RUN).cast("int"))
        found = F.transform(starts, lambda b: of(F.slice(v, b * _RUN + 1, F.lit(_RUN))))
        before = _let(found, lambda x: F.transform(x, lambda _, i: of(F.slice(x, F.lit(1), i))))
        return _let(F.struct(v.alias("v"), before.alias("b")), within)

    return _let(values, blocks)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _largest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def matches(text: Column, pattern: str, offset: Column | int = 0) -> Column:
    """All matches as structs of start, end and value; `offset` is added to the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(hits: Column) -> Column:
        # lengths of the part before each match, then of the match itself
        gaps = F.split(text, pattern, -1)
        steps = F.transform(hits, lambda h, i: F.length(h))
        starts = _let(F.struct(gaps.alias("g"), steps.alias("s")), lambda x: _before(
            F.transform(x["s"], lambda n, i: n + F.length(x["g"][i + 1])), _total
        ))
        first = F.length(gaps[0])
        return _let(F.struct(starts.alias("a"), first.alias("f")), lambda x: F.transform(
            hits, lambda h, i: F.struct(
                (x["a"][i] + x["f"] + offset).cast("int").alias("start"),
                (x["a"][i] + x["f"] + F.length(h) + offset).cast("int").alias("end"), h.alias("value"),
            )
        ))

    return _let(found, lambda hits: F.when(F.size(hits) > 0, placed(hits)).otherwise(F.array().cast(_SPAN)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(digits: Column) -> Column:
        n = F.length(digits)

        def step(a: Column, i: Column) -> Column:
            d = F.substring(digits, n - i, F.lit(1)).cast("int")
            doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return a + F.when(i % 2 == 1, doubled).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)

    return _let(_digits(value), lambda d: total(d) % 10 == 0)


def _small_parts(value: Column) -> Column:
    def fits(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(value, r"\."), fits)


def base_spans(text: Column) -> dict[str, Column]:
    """The valid spans of each kind."""
    valid = {
        "email": None,
        "ip": lambda s: _small_parts(s["value"]),
        "card": lambda s: _luhn(s["value"]),
        "phone": lambda s: F.length(_digits(s["value"])).between(9, 15),
    }
    # a text without the one character that every match holds is not searched
    hint = {"email": "@", "phone": "+"}
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = matches(text, pattern)
        if valid[kind]:
            spans = F.filter(spans, valid[kind])
        needed = F.contains(text, F.lit(hint[kind])) if kind in hint else text.rlike("[0-9]")
        out[kind] = F.when(needed, spans).otherwise(F.array().cast(_SPAN))
    return out


def _entities(kind: str, value: Column) -> Column:
    """Names of the entities that a value stands for: itself, its kind, and a part that others share."""
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    part = {
        "email": lambda: F.substring_index(plain, "@", -1), "ip": lambda: F.substring_index(plain, ".", 3),
        "card": lambda: F.substring(plain, 1, 6), "phone": lambda: F.substring(plain, 1, 5),
    }[kind]()
    return F.array(F.concat(F.lit(f"{kind}:"), plain), F.concat(F.lit(f"{kind}-part:"), part), F.lit(f"{kind}-any"))


def _replaced(text: Column, spans: Column, by: Callable[[Column, Column], Column]) -> Column:
    """The text with each of the sorted spans, which may overlap, replaced by `by` of the span and of where it is free from.

    The text is cut in blocks of spans first, as finding a place in a text takes time with its length.
    """

    def block(held: Column, b: Column) -> Column:
        free = held["free"]
        first, after = free[b * _RUN], F.coalesce(F.get(free, (b + 1) * _RUN), held["last"])
        part = F.slice(held["spans"], b * _RUN + 1, F.lit(_RUN))

        def piece(cut: Column, s: Column, at: Column) -> Column:
            return F.concat(F.substring(cut, at - first + 1, F.greatest(F.lit(0), s["start"] - at)), by(s, at))

        return _let(F.substring(text, first + 1, after - first), lambda cut: F.array_join(
            F.transform(part, lambda s, i: piece(cut, s, free[b * _RUN + i])), ""
        ))

    def whole(held: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(held["spans"]) - 1) / _RUN).cast("int"))
        rest = F.substring(text, held["last"] + 1, F.length(text))
        return F.concat(F.array_join(F.transform(blocks, lambda b: block(held, b)), ""), rest)

    def placed(found: Column) -> Column:
        ends = F.transform(found, lambda s: s["end"])
        held = F.struct(found.alias("spans"), _before(ends, _largest).alias("free"), F.array_max(ends).alias("last"))
        return F.when(F.size(found) > 0, _let(held, whole)).otherwise(text)

    return _let(spans, placed)


def _masked(text: Column, spans: Column) -> Column:
    """The text with a blank for each code point of the spans, which may overlap."""
    places = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return _replaced(text, F.array_sort(places), lambda s, at: F.repeat(
        F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at))
    ))


def _places(text: Column) -> Column:
    """All terms of a text: structs of term, start and end."""
    pairs = F.when(text.rlike(f"[{_OPEN}]"), F.concat(matches(text, _EVEN), matches(text, _ODD))).otherwise(F.array().cast(_SPAN))
    return F.transform(F.concat(matches(text, _WORD), pairs), lambda t: F.struct(
        F.lower(t["value"]).alias("term"), t["start"].alias("start"), t["end"].alias("end")
    ))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    pairs = F.when(text.rlike(f"[{_OPEN}]"), F.concat(found(_EVEN), found(_ODD))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.transform(F.concat(F.array_distinct(found(_WORD)), pairs), F.lower))


def _tagged(kind: str) -> Column:
    return F.transform(f"_{kind}", lambda s: F.struct(
        _entities(kind, s["value"]).alias("names"), s["start"].alias("start"), s["end"].alias("end")
    ))


def weighed(docs: DataFrame) -> DataFrame:
    """doc_id, text and weight: one divided by the number of rows with that text."""
    rows = texts(docs)
    keys = (F.xxhash64("text").alias("__h"), F.xxhash64("text", F.lit(1)).alias("__i"))
    copies = rows.select(*keys).groupBy("__h", "__i").agg(F.count("*").alias("__n")).where("__n > 1")
    copies = stored(copies, "copies")
    n = copies.count()
    if not n:
        return rows.withColumn("weight", F.lit(1.0))
    rows = rows.select("*", *keys).join(F.broadcast(copies) if n <= BROADCAST_IDS else copies, ["__h", "__i"], "left")
    return rows.select("doc_id", "text", (1.0 / F.coalesce("__n", F.lit(1))).alias("weight"))


def found_spans(rows: DataFrame, whole: bool = False) -> DataFrame:
    """A row id, doc_id, weight, the base spans of each kind, their entities, the hash of the text, and where there are spans
    the terms and the text; with `whole` every text."""
    kinds = base_spans(F.col("text"))
    rows = rows.select("doc_id", "weight", "text", *(c.alias(f"_{k}") for k, c in kinds.items()))
    rows = rows.withColumn("entities", F.concat(*(_tagged(k) for k in KINDS)))
    some = F.size("entities") > 0
    terms = F.when(some, _let(_masked(F.col("text"), F.col("entities")), _places))
    names = F.array_distinct(F.flatten(F.transform("entities", lambda e: e["names"])))
    rows = rows.withColumns({
        "terms": terms, "entities": names, "sha256": F.sha2("text", 256), "text": F.when(F.lit(whole) | some, F.col("text")),
    })
    return rows.withColumn("__row", F.monotonically_increasing_id())


def _summed(weight: str = "weight") -> Column:
    return F.round(F.sum(weight)).cast("long")


def _share(n_entity: str, n_texts: int) -> Column:
    """P(e), FLOOR at least."""
    return F.greatest(F.col(n_entity) / F.lit(float(n_texts)), F.lit(FLOOR))


def _lower(hits: Column, n: Column) -> Column:
    """The lower Wilson bound of the share of hits in n."""
    z = TRUST * TRUST
    p = hits / n
    # equal to z / (n + z) below 1 where all are hits, without a root that rounding could make negative
    spread = TRUST * F.sqrt(p * (1 - p) / n + z / (4 * n * n))
    return (p + z / (2 * n) - spread) / (1 + z / n)


def _row_classes(found: DataFrame, n_texts: int, generalise: float) -> DataFrame:
    """__row, reach, need and classes: those entities of a row that a term may disclose, each class of equal rows once.

    A term in more than `reach` or in fewer than `need` texts cannot disclose `generalise` of the class.
    """
    held = found.where(F.size("entities") > 0).select("__row", "weight", F.explode("entities").alias("entity"))
    classes = held.groupBy("entity").agg(
        _summed().alias("n_entity"), F.bit_xor(F.xxhash64("__row")).alias("x"), F.bit_xor(F.xxhash64("__row", F.lit(1))).alias("y")
    )
    # the share that a bound must reach; n / (n + z) is the bound when all n texts are hits
    least = F.pow(_share("n_entity", n_texts), F.lit(1 - generalise))
    classes = classes.where(F.col("n_entity") < n_texts).withColumns({
        "reach": F.col("n_entity") / least * (1 + 1e-9), "need": TRUST * TRUST * least / (1 - least) * (1 - 1e-9),
    })
    classes = stored(classes.where(F.col("n_entity") >= F.col("need")), "entities")
    rows = attach(held.select("__row", "entity"), classes, ["entity"], ["__row", "entity"])
    return rows.groupBy("__row").agg(
        F.max("reach").alias("reach"), F.min("need").alias("need"),
        F.collect_set(F.struct("x", "y", "n_entity", "reach", "need")).alias("classes"),
    )


def term_pairs(rows: DataFrame, found: DataFrame, generalise: float) -> tuple[DataFrame, int]:
    """__row, weight, term, n_term and class (x, y, n_entity) of all terms that may disclose an entity; the number of texts."""
    n_texts = round(found.agg(F.sum("weight")).first()[0] or 0)
    classes = stored(_row_classes(found, n_texts, generalise), "classes")
    counts = rows.select("weight", F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(_summed().alias("n_term"))
    least = classes.agg(F.min("need")).first()[0]
    counts = stored(counts.where(F.col("n_term") >= (least or 0.0)), "term-counts")
    held = found.where(F.size("terms") > 0).join(classes.drop("classes"), "__row").select(
        "__row", "weight", "reach", "need", F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term")
    )
    held = attach(held, counts, ["term"], ["__row", "term"])
    pairs = held.where(F.col("n_term").between(F.col("need"), F.col("reach"))).drop("reach", "need")
    pairs = pairs.join(classes.select("__row", "classes"), "__row")
    fits = F.filter("classes", lambda c: F.col("n_term").between(c["need"], c["reach"]))
    pairs = pairs.select("__row", "weight", "term", "n_term", F.explode(fits).alias("c"))
    return pairs.select("__row", "weight", "term", "n_term", "c.x", "c.y", "c.n_entity"), n_texts


def disclosures(pairs: DataFrame, n_texts: int) -> DataFrame:
    """term, class (x, y), n_near, n_term, n_entity and disclosure of each pair."""
    rows = pairs.groupBy("term", "x", "y").agg(
        _summed().alias("n_near"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity")
    )
    bound = _lower(F.col("n_near"), F.greatest("n_term", "n_near"))
    return rows.withColumn("disclosure", F.greatest(F.lit(0.0), 1 - F.log(bound) / F.log(_share("n_entity", n_texts))))


def spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, whole: bool = False) -> DataFrame:
    """doc_id, the base spans of each kind, and term spans: structs of start, end and value (the action).

    Also sha256 of the text, and the text where there are spans; with `whole` every text.
    """
    rows = weighed(docs)
    found = stored(found_spans(rows, whole), "spans")
    pairs, n_texts = term_pairs(rows, found, generalise)
    pairs = stored(pairs, "term-pairs")
    telling = disclosures(pairs, n_texts).where(F.col("disclosure") >= generalise).select(
        "term", "x", "y", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("action")
    )
    told = attach(pairs, telling, ["term", "x", "y"], ["__row", "term"]).groupBy("__row", "term").agg(F.max("action").alias("value"))
    places = found.where(F.size("terms") > 0).select("__row", F.explode("terms").alias("t")).select("__row", "t.*")
    marked = places.join(told, ["__row", "term"]).groupBy("__row")
    marked = marked.agg(F.sort_array(F.collect_list(F.struct("start", "end", "value"))).alias("_term"))
    return found.join(marked, "__row", "left").select(
        "doc_id", *(F.col(f"_{k}").alias(k) for k in KINDS),
        F.coalesce("_term", F.array().cast(_SPAN)).alias("term"), "sha256", "text",
    )


def _listed(kinds: tuple[str, ...]) -> Column:
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*(named(k) for k in kinds)), ",")


def _clean(found: DataFrame) -> Column:
    """The text of a row of `spans` with base spans as their kind in brackets, terms generalised to [TERM] or removed.

    Overlapping spans are replaced as one, by what stands for the first.
    """

    def marked(kind: str, by: Callable[[Column], Column]) -> Column:
        return F.transform(found[kind], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), by(s).alias("by")))

    base = (marked(k, lambda s, name=f"[{k.upper()}]": F.lit(name)) for k in KINDS)
    terms = marked("term", lambda s: F.when(s["value"] == "remove", "").otherwise("[TERM]"))
    marks = F.array_sort(F.concat(*base, terms))
    return _replaced(found["text"], marks, lambda s, at: F.when(s["start"] >= at, s["by"]).otherwise(""))


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and of all spans, hashes of the base spans and of the sanitised text, all spans as text."""
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed(KINDS), 256).alias("base_sha256"), _listed((*KINDS, "term")).alias("spans"),
        sum((F.size(k) for k in KINDS), F.size("term")).cast("long").alias("n_spans"),
        F.coalesce(F.sha2(_clean(found), 256), "sha256").alias("sanitised_sha256"),
    )


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """doc_id and the sanitised text of every row, rows without an id and repeated ones included; a null text is empty."""
    found = spans(docs, whole=True, **settings)
    return found.select("doc_id", _clean(found).alias("text"))


def op4_pii_sanitise(spark, sf_dir: str) -> DataFrame:
    return digests(spans(table(spark, sf_dir, "documents")))
