"""Personal data, with DataFrame functions only: patterns propose spans, checksums confirm, context adjusts the score.

A pattern's matches and what lies between them (`split` by the same pattern) give every span's place in code points.
Base kinds (email, ip, card, phone) always stay; spans of the other kinds need a score of `least`: a valid IBAN
(mod 97) has it, a long hexadecimal string only with a word like "token" in the `near` characters before it.

Defined cases: null text is empty and has no span; repeated rows, and null ids, are treated row by row; an empty table
gives an empty result; other columns stay as they are (`find_spans`) unless they have a result's name, which replaces
them. Patterns are possessive or bounded, so that very long texts need neither deep recursion nor quadratic time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that breaks ties of start: pattern for Spark, base kind or not, score, words that raise it.
KINDS = ("email", "ip", "card", "phone", "iban", "secret")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "token": r"[A-Za-z0-9]{15,}+",
    "spaced": r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3}+)?",
}
#: What a text must contain for its pattern to be worth a search.
HINTS = {"email": "@", "phone": "+"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "secret": 0.4}
WORDS = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|pay|credit",
    "phone": "phone|tel|call|mobile",
    "iban": "iban|account|bank",
    "secret": "token|secret|key|password",
}
NEAR, RAISE, LEAST = 40, 0.3, 0.6
SPAN = "array<struct<start:int,`end`:int,t:string,before:string>>"


RUN = 64


def _running(count: str, start: str, out: str, step: str, tail: str = "element_at(runs, -1).tail") -> str:
    """SQL for what a running state gives out over i = 0 to count - 1: `step` takes (a, i) to the next state.

    A state is a pos, a tail and what was given out; `start` is the first pos and tail, and `tail` what a run (k, after runs) begins with. Items are gathered in runs of RUN, so that no
    long array is copied for every item.
    """
    run = f"""aggregate(sequence(k * {RUN}, least((k + 1) * {RUN}, {count}) - 1),
      named_struct('pos', element_at(runs, -1).pos, 'tail', {tail}, 'out', cast(array() AS {out})), (a, i) -> {step})"""
    return f"""CASE WHEN {count} = 0 THEN cast(array() AS {out}) ELSE aggregate(sequence(0, cast((({count}) - 1) div {RUN} AS int)),
      array(named_struct({start}, 'out', cast(array() AS {out}))), (runs, k) -> concat(runs, array({run})), runs -> flatten(transform(runs, r -> r.out))) END"""


def _places(matches: str, between: str) -> Column:
    """Spans of the matches, and the NEAR characters before each: a running sum of the lengths of what lies before, and of the matches."""
    begin = f"a.pos + length({between}[i])"
    end = f"{begin} + length({matches}[i])"
    before = f"right(concat(a.tail, right({between}[i], {NEAR})), {NEAR})"
    tail = f"right(concat(a.tail, right({between}[i], {NEAR}), right({matches}[i], {NEAR})), {NEAR})"
    step = f"named_struct('pos', {end}, 'tail', {tail}, 'out', concat(a.out, array(named_struct('start', {begin}, 'end', {end}, 't', {matches}[i], 'before', {before}))))"
    return F.expr(_running(f"size({matches})", "'pos', 0, 'tail', ''", SPAN, step))


def luhn(t: str) -> str:
    """SQL for the Luhn test of the digits of t."""
    d = f"regexp_replace({t}, '[ -]', '')"
    return f"""aggregate(sequence(1, length({d})), 0, (a, i) -> a +
      CASE WHEN i % 2 = 1 THEN cast(substr({d}, length({d}) - i + 1, 1) AS int)
      ELSE cast((2 * cast(substr({d}, length({d}) - i + 1, 1) AS int)) % 9 + CASE WHEN substr({d}, length({d}) - i + 1, 1) = '9' THEN 9 ELSE 0 END AS int) END) % 10 = 0"""


def mod97(t: str) -> str:
    """SQL for the mod-97 test: the first four characters go last, letters count from 10."""
    moved = f"concat(substr({t}, 5), substr({t}, 1, 4))"
    return f"""aggregate(sequence(1, length({t})), 0, (a, i) -> (CASE WHEN substr({moved}, i, 1) BETWEEN '0' AND '9'
      THEN a * 10 + cast(substr({moved}, i, 1) AS int) ELSE a * 100 + ascii(substr({moved}, i, 1)) - 55 END) % 97) = 1"""


def find_spans(docs: DataFrame, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Add `pii`: array of (start, ord, kind, end, score) by start then kind, and `n_base` spans of base kinds in it."""
    # the user's columns go through in a struct, so that no name can clash
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("pii", "n_base")]
    df = docs.select(F.struct(*own).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    for name, pattern in PATTERNS.items():
        hit = F.col("_text").contains(HINTS.get(name, ""))
        df = df.withColumn(f"_m_{name}", F.when(hit, F.regexp_extract_all("_text", F.lit(f"({pattern})"), 1)).otherwise(F.array().cast("array<string>")))
    for name, pattern in PATTERNS.items():
        some = F.size(f"_m_{name}") > 0
        df = df.withColumn(f"_b_{name}", F.when(some, F.split("_text", pattern, -1)).otherwise(F.array().cast("array<string>")))
    for name in PATTERNS:
        df = df.withColumn(f"_s_{name}", _places(f"_m_{name}", f"_b_{name}"))
    plain = lambda t: f"replace({t}, ' ', '')"
    tests = {
        "email": "true",
        "ip": "forall(split(s.t, '[.]'), q -> length(ltrim('0', q)) <= 3 AND coalesce(try_cast(right(concat('000', q), 3) AS int), 999) <= 255)",
        "card": luhn("s.t"),
        "phone": "length(regexp_replace(s.t, '[^0-9]', '')) BETWEEN 10 AND 15",
        "iban": f"{plain('s.t')} RLIKE '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$' AND {mod97(plain('s.t'))}",
        "secret": "s.t RLIKE '^[0-9a-f]{32,64}$'",
    }
    from_ = {k: f"_s_{k}" for k in ("email", "ip", "card", "phone")} | {"iban": "concat(_s_token, _s_spaced)", "secret": "_s_token"}
    parts = []
    for n, kind in enumerate(KINDS):
        score = f"cast({SCORES[kind]} AS double) + CASE WHEN lower(s.before) RLIKE '{WORDS[kind]}' THEN cast({RAISE} AS double) ELSE 0D END"
        parts.append(f"transform(filter({from_[kind]}, s -> {tests[kind]}), s -> named_struct('start', s.start, 'ord', {n}, 'kind', '{kind}', 'end', s.`end`, 'score', {score}))")
    spans = f"array_sort(filter(concat({', '.join(parts)}), s -> s.ord < 4 OR s.score >= {least}))"
    df = df.withColumn("pii", F.expr(spans)).withColumn("n_base", F.expr("size(filter(pii, s -> s.ord < 4))"))
    return df.select("row.*", "pii", "n_base")


def redact(docs: DataFrame, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Put [KIND] in place of every span; of overlapping spans the first one names the place. Null text stays null."""
    found = find_spans(docs, text_col, least)
    text = f"`{text_col}`"
    # what stands before a span and its mark; of spans that overlap the first one only
    begin = "element_at(runs, -1).pos"
    part = f"substr({text}, {begin} + 1, greatest(pii[least((k + 1) * {RUN}, size(pii)) - 1].start - {begin}, 0))"  # all that a run's spans need
    before = f"substr(a.tail, a.pos - {begin} + 1, pii[i].start - a.pos)"
    step = f"""named_struct('pos', greatest(a.pos, pii[i].`end`), 'tail', a.tail, 'out', CASE WHEN pii[i].start >= a.pos
      THEN concat(a.out, array(concat({before}, '[', upper(pii[i].kind), ']'))) ELSE a.out END)"""
    parts = _running("size(pii)", "'pos', 0, 'tail', ''", "array<string>", step, part)
    new = f"CASE WHEN size(pii) = 0 OR {text} IS NULL THEN {text} ELSE concat(array_join({parts}, ''), substr({text}, array_max(transform(pii, s -> s.`end`)) + 1)) END"
    rest = {c: F.col(f"`{c}`") for c in docs.columns if c not in ("pii", "n_base")}
    return found.select(*(F.expr(new).alias(c) if c == text_col else col for c, col in rest.items()))


def query(spark, sf_dir: str) -> DataFrame:
    found = find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    listed = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.`end`)), ',')"
    counts = [F.expr(f"cast(size(filter(pii, s -> s.ord = {n})) AS long)").alias(f"n_{k}") for n, k in enumerate(KINDS[:4])]
    base = F.sha2(F.expr(listed.format("filter(pii, s -> s.ord < 4)")), 256)
    top = F.round(F.coalesce(F.expr("array_max(transform(pii, s -> s.score))"), F.lit(0.0)), 3)
    return found.select("doc_id", *counts, base.alias("base_sha256"), F.expr(listed.format("pii")).alias("spans"), top.alias("top_score"))


def _duck_places(pattern: str) -> str:
    return f"""(SELECT list({{'start': st, 'end': st + length(m), 't': m}} ORDER BY st) FROM (
      SELECT m, CAST(sum(length(b) + length(m)) OVER (ORDER BY i) - length(m) AS BIGINT) AS st FROM (
        SELECT unnest(ms) AS m, unnest(bs[1:len(ms)]) AS b, unnest(range(len(ms))) AS i FROM (
          SELECT regexp_extract_all(tx, '{pattern}') AS ms, string_split_regex(tx, '{pattern}') AS bs))))"""


def oracle() -> str:
    """The same spans in DuckDB, from the patterns as they are defined (no possessive parts or look-around)."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "token": r"[A-Za-z0-9]{15,}",
        "spaced": r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?",
    }
    cols = ",\n".join(f"{_duck_places(p)} AS {k}" for k, p in plain.items())
    d = "regexp_replace(s.t, '[ -]', '', 'g')"
    digit = f"CAST({d}[len({d}) - i + 1] AS INT)"
    v = "replace(s.t, ' ', '')"
    moved = f"({v}[5:] || {v}[:4])"
    tests = {
        "email": "true",
        "ip": "len(list_filter(string_split(s.t, '.'), lambda q: CAST(q AS HUGEINT) > 255)) = 0",
        "card": f"length({d}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} ELSE (2 * {digit}) % 10 + (2 * {digit}) // 10 END)) % 10 = 0",
        "phone": "length(regexp_replace(s.t, '[^0-9]', '', 'g')) BETWEEN 10 AND 15",
        "iban": f"regexp_full_match({v}, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND list_reduce(list_concat([0], list_transform(string_split({moved}, ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1",
        "secret": "regexp_full_match(s.t, '[0-9a-f]{32,64}')",
    }
    src = {"iban": "list_concat(coalesce(token, []), coalesce(spaced, []))", "secret": "token"}
    parts = []
    for n, k in enumerate(KINDS):
        context = f"lower(tx[greatest(s.start - {NEAR}, 0) + 1 : s.start])"
        score = f"({SCORES[k]} + CASE WHEN regexp_matches({context}, '{WORDS[k]}') THEN {RAISE} ELSE 0 END)::DOUBLE"
        parts.append(f"list_transform(list_filter(coalesce({src.get(k, k)}, []), lambda s: {tests[k]}), lambda s: {{'start': s.start, 'ord': {n}, 'kind': '{k}', 'end': s.end, 'score': {score}}})")
    all_ = "list_concat(" + ", list_concat(".join(parts[:-1]) + ", " + parts[-1] + ")" * (len(parts) - 1)
    show = lambda x: f"array_to_string(list_transform({x}, lambda s: s.kind || ':' || s.start || ':' || s.end), ',')"
    counts = ", ".join(f"CAST(len(list_filter(pii, lambda s: s.ord = {n})) AS BIGINT) AS n_{k}" for n, k in enumerate(KINDS[:4]))
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS tx FROM documents),
      p AS (SELECT doc_id, tx, {cols} FROM t),
      f AS (SELECT doc_id, list_sort(list_filter({all_}, lambda s: s.ord < 4 OR s.score >= {LEAST})) AS pii FROM p)
      SELECT doc_id, {counts}, sha256({show("list_filter(pii, lambda s: s.ord < 4)")}) AS base_sha256,
        {show("pii")} AS spans, round(coalesce(list_max(list_transform(pii, lambda s: s.score)), 0), 3) AS top_score FROM f"""
