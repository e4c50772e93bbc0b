"""Personal data by fixed patterns, and by contexts learned from what those patterns find.

The base kinds are regular expressions with a check on each match. Their matches are seeds, and so are
tokens of a shape that only made-up identifiers have: one alphabet and length, letters and digits
mixed, in many values that hardly ever come twice. Every seed and every other token, whatever its
characters, is an instance; the one and two tokens before and after it are its lexical patterns,
where a quote, a colon and an equals sign are tokens too. On the graph of patterns and instances, a
pattern's score is the lower bound (Wilson) of the share of its distinct instances that are trusted,
and an instance's score is the chance that at least one of its accepted patterns is right.
Instances that reach ``CONFIDENCE`` become trusted, which can lift further patterns, until no instance
is new. One without a digit must also have accepted patterns for ``SHARE`` of its distinct ones, or
it is a common word. Occurrences of the instances found this way are spans of kind ``id``.
Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import whole_text
from storeloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
#: The base patterns as published, written so that the matcher never goes back: a match starts where
#: a run of its first characters starts, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A character that stands for those of base spans, and what stands for it where texts have it.
MASK, UNMASK = "\ue000", "\ue001"
#: A sign that is a word of patterns but no instance.
SIGN = '[:="]'
#: A masked span, a sign, or a token from its first to its last letter or digit.
TOKEN = (rf"{MASK}+|{SIGN}|[\p{{L}}\p{{N}}](?:[^\x20\x09-\x0D=\"{MASK}]*[\p{{L}}\p{{M}}\p{{N}}])?")
#: What a long token with a digit has somewhere.
LONG = "(?<![A-Za-z0-9_])(?=[A-Za-z_]*[0-9])[A-Za-z0-9_]{16}"
#: Letters and digits of a made-up identifier, which change over twice at least.
SHAPED = r"^(?=[A-Za-z_]*[0-9]+[A-Za-z_]+[0-9]|[0-9]*[A-Za-z_]+[0-9]+[A-Za-z_])[A-Za-z0-9_]{16,}$"
#: Words that are looked for as parts of texts before any token is; more are not.
FEW = 64
CONFIDENCE = 0.9
SHARE = 0.25
_SPAN = "array<struct<start:int,end:int,value:string>>"


def match_spans(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches and the parts around them: part, match, part, ..., part."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _located(found: str, parts: str) -> Column:
    """Start, end (in code points, exclusive) and value of each match."""
    return F.expr(f"""aggregate(sequence(0, size({found}) - 1),
        named_struct('at', 0, 'out', cast(array() as {_SPAN})),
        (a, i) -> named_struct(
            'at', a.at + length({parts}[i]) + length({found}[i]),
            'out', concat(a.out, array(named_struct(
                'start', a.at + length({parts}[i]),
                'end', a.at + length({parts}[i]) + length({found}[i]),
                'value', {found}[i])))),
        a -> a.out)""")


def _valid(kind: str) -> str:
    """SQL that tells whether match ``x`` of a kind counts."""
    digits = "regexp_replace(x.value, '[^0-9]', '')"
    if kind == "ip":
        return f"x.value rlike '^{_PART}([.]{_PART}){{3}}$'"
    if kind == "phone":
        return f"length({digits}) between 9 and 15"
    if kind == "card":
        doubled = "if(i % 2 = 0, int(c), if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)))"
        return (f"length({digits}) between 13 and 19 and aggregate(transform(split(reverse({digits}), "
                f"'(?!^)(?!$)'), (c, i) -> {doubled}), 0, (s, d) -> s + d) % 10 = 0")
    return "true"


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with an array ``_base`` of kind number, start and end of all base matches, by kind
    and then start. ``text`` is a column without nulls."""
    none = F.expr(f"cast(array() as {_SPAN})")
    for kind, pattern in PATTERNS.items():
        found, parts = match_spans(F.col(text), pattern)
        cue = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
        may = F.contains(F.col(text), F.lit(cue)) if cue else F.lit(True)
        docs = docs.withColumn("_found", F.when(may, found).otherwise(F.array().cast("array<string>")))
        some = F.size("_found") > 0
        docs = docs.withColumn("_parts", F.when(some, parts)).withColumn(
            "_at", F.when(some, _located("_found", "_parts")).otherwise(none)).withColumn(
            f"_{kind}", F.expr(f"filter(_at, x -> {_valid(kind)})")).drop("_found", "_parts", "_at")
    spans = ", ".join(f"transform(_{kind}, x -> named_struct('kind', {k}, 'start', x.start, 'end', x.end))"
                      for k, kind in enumerate(KINDS))
    return docs.withColumn("_base", F.expr(f"concat({spans})")).drop(*[f"_{k}" for k in KINDS])


def masked(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_masked``, the text with each character of a base span replaced by ``MASK``, and
    ``_seeds``, the stretches so replaced, in order."""
    body = f"a.out, substring({text}, a.at + 1, greatest(x.start - a.at, 0))"
    return docs.withColumn("_spans", F.expr(
        "array_sort(transform(_base, x -> named_struct('start', x.start, 'end', x.end)))")).withColumn(
        "_out", F.expr(f"""if(size(_base) = 0, null, aggregate(_spans,
            named_struct('at', 0, 'from', -1, 'out', '', 'seeds', cast(array() as array<string>)),
            (a, x) -> if(x.end <= a.at, a, named_struct(
                'at', x.end, 'from', if(a.from < 0 or x.start > a.at, x.start, a.from),
                'out', concat({body}, repeat('{MASK}', x.end - greatest(x.start, a.at))),
                'seeds', if(a.from < 0 or x.start <= a.at, a.seeds, concat(a.seeds, array(
                    substring({text}, a.from + 1, a.at - a.from)))))),
            a -> named_struct('text', concat(a.out, substring({text}, a.at + 1)), 'seeds', concat(
                a.seeds, array(substring({text}, a.from + 1, a.at - a.from))))))""")).withColumn(
        "_masked", F.coalesce("_out.text", text)).withColumn(
        "_seeds", F.coalesce("_out.seeds", F.expr("cast(array() as array<string>)"))).drop("_spans", "_out")


def _word(token: str) -> str:
    """SQL of a token as a word of patterns: all masked stretches are alike."""
    return f"if(startswith({token}, '{MASK}'), '{MASK}', lower({token}))"


def _patterns_at(i: str) -> str:
    """SQL of the patterns of the token at a place."""
    near = {k: _word(f"get(_tokens, {i} + {k})") for k in (-2, -1, 1, 2)}
    return (f"array_compact(array(concat('< ', {near[-1]}), concat('< ', {near[-2]}, ' ', {near[-1]}), "
            f"concat('> ', {near[1]}), concat('> ', {near[1]}, ' ', {near[2]})))")


def _with_tokens(scanned: DataFrame) -> DataFrame:
    return scanned.withColumn("_tokens", F.regexp_extract_all("_masked", F.lit(TOKEN), F.lit(0)))


def _places(scanned: DataFrame) -> DataFrame:
    """Every token of every row: ``_row``, ``_i``, ``x``; null where a row has none. (Without those, Spark
    would match the pattern once more to see whether there are any.)"""
    return _with_tokens(scanned).select("_row", F.posexplode_outer("_tokens").alias("_i", "x"))


def _rows_with(scanned: DataFrame, words: DataFrame, lowered: bool = False) -> DataFrame:
    """The rows that may have one of the words (a column ``x``) as a token: where there are few words,
    those whose text contains one, which is far cheaper to see than tokens."""
    few = [r.x for r in words.select("x").distinct().limit(FEW + 1).collect()]
    if len(few) > FEW or lowered and not all(w.isascii() or w == MASK for w in few):
        return scanned
    text = F.lower("_masked") if lowered else F.col("_masked")
    return scanned.where(reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in few], F.lit(False)))


def _places_of(scanned: DataFrame, values: DataFrame) -> DataFrame:
    """Where the given tokens are: ``value``, ``_row``, ``_i``. Long ones are only looked for in rows
    that have a token as long."""
    asked = values.select(F.col("value").alias("x"))
    far = F.rlike(F.col("x"), F.lit(LONG))
    near = cut_lineage(asked.where(~far))
    found = _places(scanned.where("_long")).join(asked.where(far), "x", "left_semi")
    others = _places(_rows_with(scanned, near)).join(near, "x", "left_semi")
    return found.unionByName(others).select(F.col("x").alias("value"), "_row", "_i")


def _edges(scanned: DataFrame, places: DataFrame) -> DataFrame:
    """Each instance at one of the places (``_row``, ``_i``) with each of its patterns: ``value``,
    ``pattern``. Signs and masked stretches are none. Only the rows that have such places are
    looked at again, and in them only those."""
    at = places.groupBy("_row").agg(F.collect_set("_i").alias("_at"))
    found = _with_tokens(scanned.join(at, "_row")).select(F.expr(
        f"inline(transform(_at, i -> named_struct('value', get(_tokens, i), 'patterns', {_patterns_at('i')})))"))
    return found.where(f"value is not null and not value rlike '^({SIGN}|{MASK}+)$'").select(
        "value", F.explode("patterns").alias("pattern"))


def _edges_beside(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct instances of the given patterns, by way of the word next to the instance."""
    after = F.col("pattern").startswith("<")
    cues = patterns.select(
        F.when(after, F.substring_index("pattern", " ", -1)).otherwise(F.split("pattern", " ")[1]).alias("_cue"),
        F.when(after, 1).otherwise(-1).alias("_step")).distinct()
    cues = cut_lineage(cues)
    rows = _rows_with(scanned, cues.select(F.col("_cue").alias("x")), lowered=True)
    beside = _places(rows).withColumn("_cue", F.expr(_word("x"))).join(cues, "_cue").select(
        "_row", (F.col("_i") + F.col("_step")).alias("_i"))
    return _edges(scanned, beside).join(patterns.select("pattern"), "pattern").distinct()


def _seed_edges(scanned: DataFrame) -> DataFrame:
    """Distinct base spans with each of their patterns: ``pattern``, ``value``."""
    at = F.expr(f"filter(transform(_tokens, (x, i) -> if(startswith(x, '{MASK}'), i, null)), i -> i is not null)")
    return (_with_tokens(scanned.where("size(_seeds) > 0")).withColumn("_found", at)
            .select(F.expr(f"""inline(transform(_found, (i, k) -> named_struct(
                'value', get(_seeds, k), 'patterns', {_patterns_at('i')})))"""))
            .select("value", F.explode("patterns").alias("pattern")).distinct())


def _wilson(trusted: Column, all_: Column, z: float = 1.96) -> Column:
    share = trusted / all_
    middle = share + z * z / (2 * all_)
    spread = z * F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) / all_ + z * z / (4 * all_ * all_))
    return (middle - spread) / (1 + z * z / all_)


def shaped(scanned: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Tokens that look made up, as further seeds, wherever they are: ``value``, ``_row``, ``_i``.

    The shape of such a token is its alphabet (hexadecimal, letters of one case, of both) and its
    length. A shape is trusted if the lower bound of the share of its distinct values that stand
    between the same two tokens wherever they occur, as in copies, is ``confidence`` at least.
    """
    kind = (F.when(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
            .when(F.col("value").rlike("^([0-9a-z_]+|[0-9A-Z_]+)$"), "one case").otherwise("two cases"))
    each = cut_lineage(_with_tokens(scanned.where("_long")).select("_row", F.inline(F.filter(
        F.transform("_tokens", lambda x, i: F.struct(
            i.alias("_i"), x.alias("value"), F.concat(
                F.coalesce(F.get("_tokens", i - 1), F.lit("")), F.lit(" "),
                F.coalesce(F.get("_tokens", i + 1), F.lit(""))).alias("between"))),
        lambda x: x.value.rlike(SHAPED)))).withColumn("shape", F.concat(kind, F.length("value").cast("string"))))
    values = each.groupBy("shape", "value").agg((F.min("between") == F.max("between")).alias("_once"))
    good = values.groupBy("shape").agg(_wilson(F.count_if("_once").cast("double"), F.count("*")).alias("_right"))
    return cut_lineage(each.join(good.where(F.col("_right") >= confidence).select("shape"), "shape").select(
        "value", "_row", "_i"))


def bootstrap(scanned: DataFrame, confidence: float = CONFIDENCE) -> DataFrame | None:
    """Where the instances found are: ``value``, ``_row``, ``_i``; None when there is none. ``scanned``
    has ``_row``, ``_masked``, ``_seeds`` and ``_long`` (the row has a long token).

    An instance keeps the score that it has when it becomes trusted, and a round only looks at patterns
    that the instances new in it belong to: nothing has changed for the others. More instances
    that are not trusted only lower a pattern's score. So patterns that fall short on the rows with
    trusted instances alone are left out before all texts are searched for the others, by the word
    next to the instance.
    """
    seeds = cut_lineage(_seed_edges(scanned))
    own = seeds.groupBy("pattern").agg(F.count("*").cast("double").alias("_own"))
    fresh = shaped(scanned, confidence).withColumn("score", F.lit(1.0))
    found, sums, touched, accepted = None, own.select("pattern", F.col("_own").alias("_sum")), own, None
    while True:
        if not fresh.isEmpty():
            places = fresh.select("value", "_row", "_i")
            found = places if found is None else found.unionByName(places)
            more = cut_lineage(_edges(scanned, places).distinct().join(
                fresh.select("value", "score").distinct(), "value").groupBy("pattern").agg(F.sum("score").alias("_sum")))
            sums = cut_lineage(sums.unionByName(more).groupBy("pattern").agg(F.sum("_sum").alias("_sum")))
            touched = more if accepted is not None else sums
        elif accepted is not None or found is not None:
            return found
        # With nothing else around it, a pattern would have all of its instances trusted.
        may = sums.join(touched.select("pattern").distinct(), "pattern", "left_semi").where(
            _wilson(F.col("_sum"), F.ceil("_sum")) >= confidence)
        if accepted is not None:
            may = may.join(accepted.select("pattern"), "pattern", "left_anti")
        may = cut_lineage(may)
        rows = scanned.where("size(_seeds) > 0")
        if found is not None:
            rows = rows.unionByName(scanned.where("size(_seeds) = 0").join(
                found.select("_row").distinct(), "_row", "left_semi").select(*rows.columns))
        for part in (rows, scanned):
            if may.isEmpty():
                return found
            edges = cut_lineage(_edges_beside(part, may))
            others = edges.groupBy("pattern").agg(F.count("*").alias("_others"))
            right = _wilson(F.col("_sum"), F.coalesce("_own", F.lit(0.0)) + F.coalesce("_others", F.lit(0)))
            patterns = cut_lineage(may.join(own, "pattern", "left").join(others, "pattern", "left").select(
                "pattern", "_sum", right.alias("right")).where(F.col("right") >= confidence))
            may = patterns.select("pattern", "_sum")
        good = edges.join(patterns.select("pattern", "right"), "pattern")
        accepted = good if accepted is None else accepted.unionByName(good)
        accepted = cut_lineage(accepted)
        wrong = F.exp(F.sum(F.log1p(-F.least(F.col("right"), F.lit(1 - 1e-9)))))
        new = accepted.groupBy("value").agg((1 - wrong).alias("score"), F.count("*").alias("_accepted"))
        if found is not None:
            new = new.join(found.select("value"), "value", "left_anti")
        new = cut_lineage(new.where(F.col("score") >= confidence))
        words = cut_lineage(new.where("not value rlike '[0-9]'"))
        if not words.isEmpty():
            common = _edges(scanned, _places_of(scanned, words)).distinct().groupBy("value").agg(
                F.count("*").alias("_all")).join(words, "value").where(F.col("_accepted") < SHARE * F.col("_all"))
            new = cut_lineage(new.join(common.select("value"), "value", "left_anti"))
        if new.isEmpty():
            return found
        fresh = cut_lineage(_places_of(scanned, new).join(new.select("value", "score"), "value"))


def detect(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
           keep: Sequence[str] = (), confidence: float = CONFIDENCE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``spans`` (arrays of kind number, start
    and end in code points; kind 4 is ``id``), and a struct ``row`` of the ``keep`` columns.

    A null or empty text has no spans. Repeated rows are treated alike. Added spans never
    overlap base ones, which all stay.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.translate(
        whole_text(text), MASK, UNMASK).alias("_text"), *[F.struct(*keep).alias("row")] * bool(keep))
    scanned = cut_lineage(masked(base_spans(source, "_text"), "_text").drop("_text").withColumn(
        "_row", F.monotonically_increasing_id()).withColumn("_long", F.col("_masked").rlike(LONG)))
    found = bootstrap(scanned.select("_row", "_masked", "_seeds", "_long"), confidence)
    columns = ["doc_id", F.col("_base").alias("base")]
    if found is None:
        return scanned.select(*columns, F.col("_base").alias("spans"), *["row"] * bool(keep))
    kind = F.lit(len(KINDS))
    tokens, between = match_spans(F.col("_masked"), TOKEN)
    hits = cut_lineage(found.groupBy("_row").agg(F.sort_array(F.collect_set("_i")).alias("_hits")))
    # What lies between the hit before and this one: tokens and gaps.
    length = ("aggregate(slice(_tokens, a.i + 1, i - a.i), 0, (n, t) -> n + length(t)) + "
              "aggregate(slice(_between, a.i + 1, i - a.i), 0, (n, t) -> n + length(t))")
    added = (scanned.select("_row", "_masked").join(hits, "_row")
             .select("_row", "_hits", tokens.alias("_tokens"), between.alias("_between"))
             .withColumn("_places", F.expr(f"""aggregate(_hits,
                named_struct('i', 0, 'at', 0, 'out', cast(array() as array<struct<start:int,end:int>>)),
                (a, i) -> named_struct('i', i, 'at', a.at + {length}, 'out', concat(a.out, array(named_struct(
                    'start', a.at + {length} + length(_between[i]),
                    'end', a.at + {length} + length(_between[i]) + length(_tokens[i]))))),
                a -> a.out)"""))
             .select("_row", F.transform("_places", lambda x: F.struct(
                 kind.alias("kind"), x.start.alias("start"), x.end.alias("end"))).alias("_added")))
    both = F.when(F.col("_added").isNull(), F.col("_base")).otherwise(F.concat("_base", "_added"))
    return scanned.join(added, "_row", "left").select(
        *columns, both.alias("spans"), *["row"] * bool(keep))


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = ", ".join(f"'{k}'" for k in (*KINDS, FOUND))
    return F.expr(f"array_join(transform({spans}, x -> concat(array({names})[x.kind], ':', x.start, "
                  "':', x.end)), ',')")


def redact(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with every span of their texts replaced by its kind in angle brackets;
    null texts stay null."""
    names = ", ".join(f"'<{k.upper()}>'" for k in (*KINDS, FOUND))
    found = detect(docs, text, id_col, keep=docs.columns)
    body = f"row.`{text}`"
    clean = F.expr(f"""if(size(spans) = 0, {body}, aggregate(
        array_sort(transform(spans, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind))),
        named_struct('at', 0, 'out', ''),
        (a, x) -> if(x.end <= a.at, a, named_struct('at', x.end, 'out', concat(a.out,
            substring({body}, a.at + 1, greatest(x.start - a.at, 0)), array({names})[x.kind]))),
        a -> concat(a.out, substring({body}, a.at + 1))))""")
    return found.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
                          for c in docs.columns])
