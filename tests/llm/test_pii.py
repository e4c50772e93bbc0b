import math
import random
import re
from collections import Counter, defaultdict

import regex

from storeloom.llm import pii

#: The patterns as published.
PUBLISHED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
             "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain(text):
    return [(k, m.start(), m.end()) for k, kind in enumerate(PUBLISHED)
            for m in re.finditer(PUBLISHED[kind], text) if valid(kind, m[0])]


def test_base_spans(spark):
    rng = random.Random(1)
    parts = ["a", "b", "@", ".", "-", "1", "2", "5", "0", " ", "+", "(", ")", "é", "🙂", "\n", "_", "%", "25",
             "255", "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (988) 555-2485", "4111111111111111"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2500)]
    texts += ["", None, "x" * 100_000, "1" * 50_000, "a." * 20_000 + "@b" + ".c" * 20_000, "1." * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in pii.detect(docs).collect():
        assert [tuple(s) for s in r.base] == plain(texts[r.doc_id] or ""), texts[r.doc_id]


def learned(spark):
    seeds = [(i, f"w{i} contact address for user{i}@mail{i}.com today please w{i}") for i in range(300)]
    new = [(1000 + i, f"other contact address for ZX{i}Q9, today") for i in range(2)]
    same = [(2000, "elsewhere ZX1Q9 stands alone")]
    other = [(3000 + i, f"the version number {i}.0 is good") for i in range(300)]
    return spark.createDataFrame(seeds + new + same + other, "doc_id long, text string")


def test_contexts_find_what_no_pattern_covers(spark):
    rows = {r.doc_id: r for r in pii.detect(learned(spark)).select(
        "doc_id", pii.span_text("base").alias("base"), pii.span_text("spans").alias("spans")).collect()}
    assert rows[1000].base == "" and rows[1000].spans == "id:26:31"
    assert rows[2000].spans == "id:10:15"
    assert rows[5].base == rows[5].spans == "email:23:38"
    assert all(not r.spans for i, r in rows.items() if i >= 3000)


def test_redact(spark, clashing):
    rows = {r.doc_id: r.text for r in pii.redact(learned(spark)).where("doc_id in (5, 1000, 3000)").collect()}
    assert rows == {5: "w5 contact address for <EMAIL> today please w5",
                    1000: "other contact address for <ID>, today", 3000: "the version number 0.0 is good"}
    same = pii.redact(clashing)
    assert same.columns == clashing.columns
    assert Counter(r.text for r in same.collect()) == Counter(r.text for r in clashing.collect())
    overlapping = spark.createDataFrame([(1, "call 4111111111111111 or +1 (988) 555-2485 é1.2.3.4")],
                                        "doc_id long, text string")
    assert pii.redact(overlapping).first().text == "call <CARD> or <PHONE> é<IP>"


def test_empty(spark, docs):
    assert pii.detect(docs.limit(0)).count() == 0
    assert pii.redact(docs.limit(0)).columns == docs.columns


def test_native(spark, docs):
    plan = pii.detect(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shapes_one_word_cues_and_all_rounds(spark):
    name = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(3))
    # Each cue is accepted only once what the cue before it finds is trusted.
    rows = [f"cue{'abcde'[k]}: {y}" for k in range(5) for y in (
        *[f"{name(i)}@example.com" for i in range(150)],
        *[f"qz{'abcde'[j]}(at){name(i)}" for j in (k - 1, k) if j >= 0 for i in range(6)])]
    rows += ["cuea: table", *[f"the table {name(i)} and {name(i + 1)} table" for i in range(50)]]
    got = pii.detect(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    for r in got:
        said = [rows[r.doc_id][s.start:s.end] for s in r.spans]
        assert said == ([] if "table" in rows[r.doc_id] else [rows[r.doc_id].split()[-1]])


def wilson(part, whole, z=1.96):
    p = part / whole
    return (p + z * z / (2 * whole) - z * math.sqrt(max(p * (1 - p), 0) / whole + z * z / (4 * whole * whole))) / (
        1 + z * z / whole)


def graph(texts, confidence=0.9, share=0.25):
    """The bootstrap in plain Python: the values that get spans of kind ``id``."""
    edges, seeds, between = defaultdict(set), defaultdict(set), defaultdict(set)
    for text in texts:
        spans = sorted((a, b) for _, a, b in plain(text))
        tokens, at = [], 0
        token = regex.compile(r'[:="]|[\p{L}\p{N}](?:[^\x20\x09-\x0D="\ue000]*[\p{L}\p{M}\p{N}])?')
        for a, b in spans:
            tokens += [(m, False) for m in token.findall(text[at:a])] + [(text[a:b], True)]
            at = b
        tokens += [(m, False) for m in token.findall(text[at:])]
        said = ["\ue000" if seed else t.lower() for t, seed in tokens]
        for i, (t, seed) in enumerate(tokens):
            if t in (":", "=", '"') and not seed:
                continue
            around = [("<", *said[max(0, i - n):i]) for n in (1, 2) if i >= n] + [
                (">", *said[i + 1:i + 1 + n]) for n in (1, 2) if i + n < len(said)]
            (seeds if seed else edges)[t].update(around)
            if not seed:
                between[t].add((tokens[i - 1][0] if i else "", tokens[i + 1][0] if i + 1 < len(tokens) else ""))
    shapes = defaultdict(list)
    for v in edges:
        if len(v) >= 16 and re.fullmatch("[A-Za-z0-9_]+", v) and len(re.findall("[0-9](?=[A-Za-z_])|[A-Za-z_](?=[0-9])", v)) > 1:
            kind = next(p for p in ("[0-9a-f]+|[0-9A-F]+", "[0-9a-z_]+|[0-9A-Z_]+", ".*") if re.fullmatch(p, v))
            shapes[kind, len(v)].append(v)
    trusted = {}
    for values in shapes.values():
        score = wilson(sum(len(between[v]) == 1 for v in values), len(values))
        trusted |= {v: 1.0 for v in values if score >= confidence}
    own = Counter(p for ps in seeds.values() for p in ps)
    all_ = own + Counter(p for ps in edges.values() for p in ps)
    while True:
        sums = defaultdict(float, own)
        for v, score in trusted.items():
            for p in edges[v]:
                sums[p] += score
        right = {p: w for p, s in sums.items() if (w := wilson(s, all_[p])) >= confidence}
        new = {}
        for v, ps in edges.items():
            good = [right[p] for p in ps if p in right]
            score = 1 - math.prod(1 - min(r, 1 - 1e-9) for r in good)
            if good and score >= confidence and (re.search("[0-9]", v) or len(good) >= share * len(ps)):
                new[v] = score
        if set(new) <= set(trusted):
            return set(trusted)
        trusted = new | trusted  # a score stays as it was when its instance became trusted


def secrets():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [f'{text(9)} token = "{hexes(40)}" {text(4)}' for _ in range(60)]
    rows += [f'{text(3).upper()} TOKEN = "{hexes(40).upper()}"!! {text(2)}' for _ in range(4)]
    rows += [f"{text(5)} password={hexes(18)} {text(5)}" for _ in range(90)] + [f"{text(3)} password=letmein {text(2)}"]
    rows += [f"{text(4)} AKIA{''.join(rng.choices('ABCDEFGHJK23456789', k=16))} {text(4)}" for _ in range(50)]
    rows += [f"{text(4)} release2024candidate{k}final {text(4)}" for k in range(9)]
    rows += [f"{text(6)} mail me: u{k}@example.com, {text(3)}" for k in range(120)] + [f"mail me: zq-{k}x, {text(2)}" for k in range(3)]
    rows += rows[:40]  # copies
    rows += [f"{text(4)} {code} {text(4)}" for code in ["PRODUCT17CODE88XY"] for k in range(40)]
    return rows + [f"{text(30)} in 2024: {k} of {text(20)}" for k in range(200)]


def test_graph_against_plain_python(spark):
    rows = secrets()
    want = graph(rows)
    # In one of the 64 hexadecimal ones a run of digits is a card number.
    assert sum(len(v) == 40 for v in want) == 63 and sum(v.startswith("AKIA") for v in want) == 50
    assert "letmein" in want and {"zq-0x", "zq-1x", "zq-2x"} <= want and not any("release" in v or "PRODUCT" in v for v in want)
    got = pii.detect(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)).collect()
    found = {rows[r.doc_id][x.start:x.end] for r in got for x in r.spans if x.kind == 4}
    assert found == want
    for r in got:
        assert [tuple(x) for x in r.base] == plain(rows[r.doc_id])
        if r.doc_id >= len(rows) - 200:
            assert not r.spans
