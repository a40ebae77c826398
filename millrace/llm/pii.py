"""Personal data in texts: fixed patterns, and identifiers discovered from the contexts of those.

Native throughout: expressions and joins only.  Every valid span of a fixed pattern is a seed.  Every token that looks
like an identifier is an instance, the words beside it are its patterns.  A pattern scores by the share of its distinct
instances that are known and by their number; instances that trusted patterns agree on become known, and so in rounds
until no instance is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.storage import materialize

KINDS = ("email", "ip", "card", "phone")
# The patterns of the four kinds, written so that a search neither starts again inside a run that has
# failed nor goes back inside one.  "\\G" allows for a match that begins where the last one ended.
EMAIL_CHAR, HOST_CHAR = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{EMAIL_CHAR}]))[{EMAIL_CHAR}]++@[{HOST_CHAR}]++(?:\.[{HOST_CHAR}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}  # a text without it has no match
# A phone or an e-mail address; an IBAN in blocks; digit groups of six digits or more; else parts of letters and digits
# with a digit among them, six characters or more, or five where letters and digits mix.  Such parts begin at the first
# of them or behind a match, so that a run without a match is searched once.
GROUP = r"(?:\([0-9]++\)|[0-9]++)"
GROUPS = rf"{GROUP}(?:[./-]?{GROUP})*+(?![._-]?[A-Za-z0-9])"
CHAR = r"(?:[A-Za-z0-9][._-]?)"
INSTANCE = (
    rf"{PATTERNS['phone']}|{PATTERNS['email']}"
    r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}(?![A-Za-z0-9])){2,7}+(?: [A-Z0-9]{1,3}(?![A-Za-z0-9]))?+"
    rf"|(?<![A-Za-z0-9])(?=\(?[0-9](?:\)?(?: {{1,2}}|[./-])?\(?[0-9]){{5}}){GROUPS}(?: {{1,2}}{GROUPS})*+"
    r"|(?<![A-Za-z0-9])(?:(?<![A-Za-z0-9][._-])|(?<=\G[._-]))(?=[A-Za-z]*+(?:[._-][A-Za-z]++)*+[._-]?[0-9])"
    rf"(?:(?={CHAR}{{6}})|(?={CHAR}{{5}})(?=(?:[0-9]++[._-]?)*+[A-Za-z]))"
    r"[A-Za-z0-9]++(?:[._-][A-Za-z0-9]++)*+"
)
BLOCK = 256
LEAST_KNOWN = 3
LEAST_SHARE = 0.6
ACCEPT = 0.8


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def starts(gaps: Column, found: Column) -> Column:
    """Where each match begins, in code points: all that stands before it, summed by blocks so that long arrays stay linear."""
    lengths = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, s: a + s["g"] + s["m"])
    rows = F.floor((F.size(found) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), rows), lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))

    def begin(s: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        before = F.aggregate(F.slice(blocks, F.lit(1), block), F.lit(0), lambda a, n: a + n)
        return before + total(F.slice(lengths, block * BLOCK + 1, i % BLOCK)) + s["g"]

    return F.when(F.size(found) > 0, F.transform(lengths, begin)).otherwise(F.array().cast("array<int>"))


def valid(kind: str, m: Column) -> Column:
    """Whether a match of the pattern counts."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(256)) <= 255)
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _searched(docs: DataFrame) -> DataFrame:
    """``doc_id, body_hash, base`` (valid spans ``kind, start, end``), ``seen`` (seeds and instances with contexts) of every row."""
    body = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).withColumn(
        "digits", F.regexp_like("body", F.lit("[0-9]"))
    )
    none = F.array().cast("array<string>")
    for kind in KINDS:
        asked = F.contains("body", F.lit(NEEDS[kind])) & (F.lit(True) if kind == "email" else F.col("digits"))
        rows = rows.withColumn(f"m_{kind}", F.when(asked, matches(F.col("body"), PATTERNS[kind])).otherwise(none))
    rows = rows.withColumn("m_seen", F.when(F.col("digits") | F.contains("body", F.lit("@")), matches(F.col("body"), INSTANCE)).otherwise(none))
    for kind in (*KINDS, "seen"):
        pattern = PATTERNS.get(kind, INSTANCE)
        rows = rows.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("body", pattern, -1)).otherwise(none))
    for kind in (*KINDS, "seen"):
        rows = rows.withColumn(f"s_{kind}", starts(F.col(f"g_{kind}"), F.col(f"m_{kind}")))

    def spans(kind: str) -> Column:
        pairs = F.zip_with(f"m_{kind}", f"s_{kind}", lambda m, s: F.struct(m.alias("m"), s.alias("s")))
        kept = F.filter(pairs, lambda p: valid(kind, p["m"]))
        return F.transform(kept, lambda p: _span(p["s"], KINDS.index(kind), p["s"] + F.length(p["m"])))

    word = r"[^\x20\x09-\x0D]+"
    tidy = lambda c: F.lower(F.trim(F.regexp_replace(c, r"[\x20\x09-\x0D]+", " ")))

    def contexts(name: str, kind: Column | None) -> Column:
        """Matches with the words beside them in the text, whatever else matches there, so that all kinds compare.

        Words are taken whole, as far as two matches away on the left and one on the right.
        """
        part = lambda x, i: F.coalesce(F.get(f"{x}_{name}", i), F.lit(""))

        def context(m: Column, i: Column) -> Column:
            # The words before a match are read backwards, so that either side is searched from its beginning only.
            left = F.reverse(F.concat(part("m", i - 2), part("g", i - 1), part("m", i - 1), part("g", i)))
            right = F.concat(part("g", i + 1), part("m", i + 1), part("g", i + 2))
            two = F.reverse(F.regexp_extract(left, rf"^[\x20\x09-\x0D]*+({word}+)[\x20\x09-\x0D]++({word}+)", 0))
            one = F.reverse(F.regexp_extract(left, rf"^[\x20\x09-\x0D]*+({word}+)", 0))
            after = F.regexp_extract(right, rf"^[\x20\x09-\x0D]*+({word}+)", 0)
            return F.struct(
                m.alias("instance"), F.get(f"s_{name}", i).alias("start"), (_kind_of(m) if kind is None else kind).cast("int").alias("kind"),
                F.when(two != "", F.concat(F.lit("l:"), tidy(two))).alias("left"),
                F.when((one != "") & (after != ""), F.concat(F.lit("b:"), tidy(one), F.lit(" _ "), tidy(after))).alias("beside"),
            )

        found = F.transform(f"m_{name}", context)
        return found if kind is None else F.filter(found, lambda s: valid(name, s["instance"]))

    seeds = [contexts(kind, F.lit(k)) for k, kind in enumerate(KINDS)]
    rows = rows.withColumn("base", F.array_sort(F.concat(*map(spans, KINDS)))).withColumn("seen", F.concat(*seeds, contexts("seen", None)))
    return rows.select("doc_id", F.xxhash64("body").alias("body_hash"), "base", "seen")


def _span(start: Column, kind: Column | int, end: Column) -> Column:
    """Sorts by start, then kind as listed."""
    return F.struct(start.cast("int").alias("start"), (F.lit(kind) if isinstance(kind, int) else kind).cast("int").alias("kind"), end.cast("int").alias("end"))


def _kind_of(m: Column) -> Column:
    """Number of the kind that the whole of ``m`` is, NULL if it is none."""
    whole = F.lit(None).cast("int")
    for k in reversed(range(len(KINDS))):
        is_kind = F.regexp_like(m, F.lit(rf"\A(?:{PATTERNS[KINDS[k]]})\z")) & valid(KINDS[k], m)
        whole = F.when(is_kind, k).otherwise(whole)
    return whole


def discovered(seen: DataFrame) -> DataFrame:
    """``instance, kind``: identifiers that no fixed pattern knows, for rows of ``instance, kind, left, beside``.

    A pattern's score is its share of known instances, if at least ``LEAST_KNOWN`` distinct ones are known and the share is
    ``LEAST_SHARE`` or more.  An instance is accepted if ``1 - product(1 - score)`` over its patterns reaches ``ACCEPT``;
    it takes the kind that most of the score stands for, the first listed on a tie.  Scores only grow as more is known,
    so that the rounds end.
    """
    pairs = seen.select("instance", F.explode(F.array("left", "beside")).alias("pattern")).filter("pattern IS NOT NULL")
    edges = materialize(pairs.distinct(), "edges")
    known = materialize(seen.filter("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind")), "known")
    seeds, before, added = known, -1, 0
    while added > before:
        marked = edges.join(known, "instance", "left")
        scores = marked.groupBy("pattern").agg(
            F.count("*").alias("n"), F.count("kind").alias("k"), F.expr("mode(kind, true)").alias("pattern_kind")
        ).filter((F.col("k") >= LEAST_KNOWN) & (F.col("k") >= LEAST_SHARE * F.col("n")))
        # A smoothed share: a few known instances alone never count as certain.
        trusted = materialize(scores.select("pattern", "pattern_kind", (F.col("k") / (F.col("n") + 1)).alias("score")), "trusted")
        votes = edges.join(trusted, "pattern").groupBy("instance", "pattern_kind").agg(F.sum(F.log(1 - F.col("score"))).alias("doubt"))
        agreed = votes.groupBy("instance").agg(
            F.sum("doubt").alias("doubt"), F.min_by("pattern_kind", F.struct("doubt", "pattern_kind")).alias("kind")
        ).filter(1 - F.exp("doubt") >= ACCEPT)
        fresh = agreed.select("instance", "kind").join(seeds, "instance", "left_anti")
        fresh = materialize(fresh, "fresh")
        before, added = added, fresh.count()
        known = seeds.unionByName(fresh)
    return fresh


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, body_hash, base, spans, instances``: a row for each row of ``docs``.

    ``base`` are the spans ``start, kind, end`` of the fixed patterns in order, ``spans`` those and the discovered ones,
    ``instances`` the strings discovered in the text.  A NULL text is an empty one; ids may be NULL or repeated; an empty
    table gives no rows.  A discovered span that overlaps a base span is left out, as its text is found already.
    """
    rows = materialize(_searched(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), "searched")
    seen = materialize(rows.filter(F.size("seen") > 0).select("doc_id", "body_hash", "base", F.explode("seen").alias("s")), "seen")
    found = materialize(discovered(seen.select("s.*")), "found").withColumnRenamed("kind", "found_kind")
    hits = seen.select("doc_id", "body_hash", "base", F.col("s.instance").alias("instance"), F.col("s.start").alias("start")).join(found, "instance")
    end = F.col("start") + F.length("instance")
    apart = ~F.exists("base", lambda b: (b["start"] < end) & (b["end"] > F.col("start")))
    more = (
        hits.filter(apart).withColumn("span", _span(F.col("start"), F.col("found_kind"), end))
        .groupBy("doc_id", "body_hash").agg(F.collect_set("span").alias("more"), F.collect_set("instance").alias("instances"))
    )
    more = materialize(more, "more").withColumnsRenamed({"doc_id": "_doc", "body_hash": "_hash"})
    joined = rows.drop("seen").join(more, (F.col("body_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(more.schema["more"].dataType))))
    return joined.select("doc_id", "body_hash", "base", spans.alias("spans"), F.coalesce("instances", F.array().cast("array<string>")).alias("instances"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of ``find_personal_data``."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text`` and more columns) with every span in ``text`` replaced by ``[EMAIL]``, ``[IP]`` and so on.

    Discovered identifiers go first, then the kinds one after another, each where its pattern still matches, so nested
    matches are masked once.  Texts without any span, NULL ones too, stay as they are.
    """
    found = find_personal_data(docs).filter(F.size("spans") > 0)
    some = materialize(found.select("doc_id", "body_hash", "instances").distinct(), "masks").withColumnsRenamed(
        {"doc_id": "_doc", "body_hash": "_hash", "instances": "_instances"}
    )
    hashed = docs.withColumn("_body_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = (F.col("_body_hash") == F.col("_hash")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_doc"))
    rows = hashed.join(some, same, "left")
    text = _rebuilt(F.col("text"), INSTANCE, lambda m: F.when(F.array_contains("_instances", m), "[ID]").otherwise(m))
    rows = rows.withColumn("text", F.when(F.size("_instances") > 0, text).otherwise(F.col("text")))
    for kind in ("email", "phone", "ip", "card"):
        text = _rebuilt(F.col("text"), PATTERNS[kind], lambda m, kind=kind: F.when(valid(kind, m), f"[{kind.upper()}]").otherwise(m))
        rows = rows.withColumn("text", F.when(F.col("_hash").isNotNull(), text).otherwise(F.col("text")))
    return rows.select(*docs.columns)


def _rebuilt(text: Column, pattern: str, shown) -> Column:
    parts = F.zip_with(F.split(text, pattern, -1), matches(text, pattern), lambda g, m: F.concat(g, F.when(m.isNull(), "").otherwise(shown(m))))
    return F.array_join(parts, "")
