"""Awkward small tables, and brute-force versions of the operators' contracts."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SYLLABLES = {"en": "the and ing ion er st re th ou ly be ha", "fr": "le que eau oi ment aux tion é è ier vi pa", "de": "der sch ung ein ich keit ü ö be ver st au"}


def prose(rng: random.Random, n: int, lang: str = "en", line: int = 12) -> str:
    parts = SYLLABLES[lang].split()
    words = ["".join(rng.choice(parts) for _ in range(rng.choice((1, 2, 2, 3)))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) + "." for i in range(0, n, line))


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(words)


def benchmark_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = [(i, prose(rng, 30 + i)) for i in range(12)]
    rows += [(12, "Only four words here"), (13, ""), (14, None), (15, "..."), (None, prose(rng, 25)), (3, rows[3][1]), (16, "ONE " * 14), (17, rows[2][1])]
    return rows


def document_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, words, kept): the last two clash with names operators use."""
    rng = random.Random(3)
    bench = benchmark_rows()
    out: list[str | None] = []
    langs: list[str | None] = []
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        out.append(prose(rng, rng.choice((8, 40, 120, 300)), lang))
        langs.append(lang)
    for i in range(0, 24):      # near and exact copies, chains of edits
        base = out[i % 12]
        out.append(base if i % 4 == 0 else edited(rng, out[-1] if i % 4 == 3 else base, 0.04))
        langs.append(langs[i % 12])
    passage = prose(rng, 90)
    for i in range(10):
        out.append(prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 20))
        out.append(f"{prose(rng, 25)} {bench[i][1]} {prose(rng, 6)}")
        out.append("so Only, FOUR words here " + prose(rng, 5))
        langs += ["en"] * 3
    out += [None, "", " \n\t ", "one", "One", "a b", "...", "é", "123 456", "x" * 5000, "ab " * 3000, "\n".join(["", "", ""] * 20), "one " * 40,
            prose(rng, 9000), "▁ odd ▁▁ spaces  and\ttabs\r\n", "日本語のテキスト 文字", "a\x00b", "\n".join(["same line here"] * 30)]
    langs += [None] + ["en"] * 17
    rows = [(i, t, lang, f"src{i % 3}", None if t is None else len(t), "w", i % 2 == 0) for i, (t, lang) in enumerate(zip(out, langs))]
    rows += [rows[5], rows[5], (None, out[6], "en", None, 3, None, None), (None, "no id and alone in this place", None, None, None, None, None), (7, prose(rng, 50), "en", "src0", 1, "", True)]
    return rows


def page_rows() -> list[tuple]:
    rng = random.Random(9)
    rows = [(i, f"http://a.example/{i}", f"<html>{prose(rng, 60)}</html>") for i in range(40)]
    rows += [(100 + i, f"http://b.example/{i}\r\nX: y", rows[i % 5][2]) for i in range(20)]
    rows += [(200, None, None), (201, "u", ""), (202, "short", "tiny"), (203, "short", "tiny"), (204, "é ü", "é" * 49), (205, "é", "é" * 49), (206, "b", "b" * 100),
             (207, "b", "b" * 100), (208, "long", "z" * 300_000), (None, "null id", rows[0][2]), (None, "null id", "n" * 150), (0, rows[0][1], rows[0][2]), (209, "crlf", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return rows


def label_rows() -> list[tuple]:
    return [(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(0, 90, 2)] + [(3, None, None), (None, 1, 1), (4, 0, 1), (10 ** 9, 1, 0)]


def conversation_rows() -> list[tuple]:
    """(conv_id, turn, role, text, pos): the last clashes with a name the operator uses."""
    rng = random.Random(21)
    roles = ("user", "assistant")
    out = []
    for base in (0, 100, 300):
        for c in range(base, base + 30, 1 + base // 100):
            out += [(c, k, roles[k % 2], f"t{rng.randrange(4)}" if rng.random() < 0.7 else prose(rng, 6), "x") for k in range(rng.randrange(1, 9))]
    for c in range(500, 540):        # copies of one conversation, and of one with other ends
        out += [(c, k, roles[k % 2], f"same {k}", None) for k in range(6 + c % 3)]
    out += [(700, k, "user", "long é", "x") for k in range(150)] + [(799, 0, "user", "own", "x"), (710, 9, "user", "long é", "x")]
    out += [(801, None, None, None, "x"), (801, 0, None, "", "x"), (801, 0, "", "b", "x"), (801, 0, "a", "b", "x"), (801, 0, "a", "b", "x"), (802, 5, "user", "", "x")]
    out += [(None, 0, "user", "nobody", "x"), (-5, 0, "user", "t1", "x"), (-105, 1, "user", "t2", "x"), (-100, 0, "user", "minus", "x"), (2 ** 62, 0, "user", "x" * 10_000, "x")]
    # conversations that lose all their own turns and have no base
    out += [(c, 0, "user", "gone", "x") for c in range(901, 920)]
    rng.shuffle(out)
    return out


def prefix_nodes(rows: list[tuple], share: int = 100, heads: int = 6) -> list[tuple]:
    own: dict = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, hashlib.md5(role.encode()).digest(), hashlib.md5(text.encode()).digest())
            own[c].append((key, (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % share) * (1 if c >= 0 else -1)
        members[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes: dict = collections.defaultdict(list)
    for c, v in members.items():
        for d in range(len(v) + 1):
            nodes[v[:d]].append(c)
    children = collections.defaultdict(int)
    leaves, saved = collections.Counter(), collections.Counter()
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, ids in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(ids) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, ids in nodes.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(members[c]) == len(k))
        out.append((min(ids), len(k), min(nodes[k[:-1]]) if k else None, len(ids), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def filter_audit(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """``docs``: (doc_id, text, lang); ``labels``: (doc_id, quality, toxic)."""
    first: dict = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    bad = {i for i, _, x in labels if i is not None and x == 1}
    parts = collections.defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and t in first and first[t] < i}
        parts[lang or ""].append((fails, i in good, i in bad))
    out = []
    for part, rows in parts.items():
        shapley = collections.Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                gone = [any(x[0][e] for e in order[:k]) for x in rows]
                here = [x[0][f] and not g for x, g in zip(rows, gone)]
                shapley[f] += sum(here)
                steps.append((part, "".join(order), k + 1, sum(not g and not x[0][f] for x, g in zip(rows, gone)), sum(here), sum(x[0][f] and g for x, g in zip(rows, gone)),
                              sum(x[0][f] and sum(x[0].values()) == 1 for x in rows), sum(h and x[1] for x, h in zip(rows, here)), sum(h and x[2] for x, h in zip(rows, here)), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return out


def write_tables(spark, path: str, empty: bool = False) -> str:
    for name, rows, schema in (
            ("documents", document_rows(), "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept boolean"),
            ("benchmark", benchmark_rows(), "item_id long, text string"), ("pages", page_rows(), "page_id long, url string, html string"),
            ("conversations", conversation_rows(), "conv_id long, turn long, role string, text string, pos string"),
            ("labels", label_rows(), "doc_id long, quality int, toxic int")):
        spark.createDataFrame([] if empty else rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


def contaminated(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    windows = collections.defaultdict(set)
    for name, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        for k in [tuple(w[j:j + window]) for j in range(len(w) - window + 1)] if len(w) >= window else [tuple(w)] if w else []:
            windows[k].add(name)
    sizes, out = {len(k) for k in windows}, []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_groups(docs: list[tuple], n: int) -> list[tuple]:
    sets = [shingles(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least: dict = {}
    for i, (doc_id, _) in enumerate(docs):
        least.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in least[root(i)] if x is not None] if sets[i] else [doc_id]
        component = min((x for x in ids if x is not None), default=None)
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def without_repeats(docs: list[tuple], length: int = 400) -> list[tuple]:
    raw = [(t or "").encode() for _, t in docs]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(docs, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len([1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])])
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def cut_lines(docs: list[tuple], n: int = 3) -> list[tuple]:
    """(doc_id, n_lines, n_removed, text); rows of one doc_id and text are one document."""
    order = sorted({d for d in docs}, key=lambda d: (d[0] is None, d[0] or 0, str(d[1])))
    seen, result = set(), {}
    for doc_id, text in order:
        lines = [] if text is None else text.split("\n")
        gone = set()
        for i in range(len(lines) - n + 1):
            w = tuple(lines[i:i + n])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                gone.update(range(i, i + n))
            seen.add(w)
        result[doc_id, text] = (doc_id, len(lines), len(gone), text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return [result[d] for d in docs]


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated_lines, len(covered)


def rows_of(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def _kn_model(texts: list[bytes], order: int = 5):
    """log2 probability of a byte after four, from a modified Kneser-Ney model counted in dicts."""
    counts: list[dict] = [collections.Counter() for _ in range(order + 1)]
    for t in texts:
        padded = bytes(order - 1) + t
        for i in range(len(t)):
            counts[order][padded[i:i + order]] += 1
    for k in range(order - 1, 0, -1):
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1
    discount, total, less = [None], [None], [None]
    for k in range(1, order + 1):
        n = collections.Counter(min(c, 5) for c in counts[k].values())
        d = (0.5, 1.0, 1.5)
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            d = tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3))
        sums, cut = collections.Counter(), collections.Counter()
        for g, c in counts[k].items():
            sums[g[:-1]] += c
            cut[g[:-1]] += d[min(c, 3) - 1]
        discount.append(d), total.append(sums), less.append(cut)

    def p(g: bytes) -> float:
        k = len(g)
        if not k:
            return 1 / 256
        below, n = p(g[1:]), total[k][g[:-1]]
        if not n:
            return below
        c = counts[k][g]
        return (c - discount[k][min(c, 3) - 1] if c else 0.0) / n + less[k][g[:-1]] / n * below

    return lambda g: math.log2(p(g))


def held_out_bits(rows: list[tuple], fold: list[int]) -> list[float]:
    """Of each (text, lang), the bits per byte by the model of its language's other fold."""
    texts = collections.defaultdict(list)
    for (t, lang), f in zip(rows, fold):
        texts[lang or "", f].append((t or "").encode())
    models = {(x, f): _kn_model(texts.get((x, f), [])) for x, _ in list(texts) for f in (0, 1)}
    out = []
    for (t, lang), f in zip(rows, fold):
        raw = (t or "").encode()
        padded, log2 = bytes(4) + raw, models[lang or "", 1 - f]
        out.append(sum(-log2(padded[i:i + 5]) for i in range(len(raw))) / max(len(raw), 1))
    return out


def within_bands(rows: list[tuple], spread: float) -> list[bool]:
    """Of each (text, lang, bits), whether it is inside the wider of its language's two bands."""
    def size(t):
        return max(len((t or "").encode()), 1)

    def quartile(values, q, unit):
        units = sorted(math.floor(abs(v) / unit + 0.5) * (1 if v >= 0 else -1) for v in values)
        return units[math.ceil(q * len(units)) - 1] * unit

    fences = {}
    for lang in {x or "" for _, x, _ in rows}:
        good = []
        for t, x, b in rows:
            c = base_counts(t)
            if (x or "") == lang and c[0] >= 10 and 100 * c[4] <= 20 * c[0]:
                good.append((b, size(t)))
        if good:
            q1, q2, q3 = (quartile([b for b, _ in good], q, 0.001) for q in (0.25, 0.5, 0.75))
            r1, r3 = (quartile([(b - q2) * math.sqrt(n) for b, n in good], q, 0.1) for q in (0.25, 0.75))
            fences[lang] = (q1 - spread * (q3 - q1), q3 + spread * (q3 - q1), q2, r1 - spread * (r3 - r1), r3 + spread * (r3 - r1))
    out = []
    for t, x, b in rows:
        if (x or "") not in fences:
            out.append(True)
            continue
        low, high, mid, r_low, r_high = fences[x or ""]
        root = math.sqrt(size(t))
        out.append(min(low, mid + r_low / root) <= b <= max(high, mid + r_high / root))
    return out
