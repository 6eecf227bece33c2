"""Plain Python versions of the operators' results."""

import base64
import collections
import hashlib
import math
import re
import struct
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def warc(pages):
    """pages: (id, html); rows as op1 returns them."""
    best = {}
    for i, html in pages:
        body = (html or "").encode()
        if i is not None:
            best[body] = max(best.get(body, i), i)
    out = []
    for i, html in pages:
        body = (html or "").encode()
        top = best.get(body)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "response" if top == i else "revisit", None if top == i else top))
    return out


def tokens(docs, tokenizer):
    at, out = 0, []
    for i, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def substrings(docs, length=35):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    often = collections.Counter(tuple(w[k : k + length]) for _, w in words for k in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - length + 1):
            if often[tuple(w[k : k + length])] > 1:
                gone.update(range(k, k + length))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def jaccard(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def secrets(docs):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    kinds, out = ["assign", "access", "hex"], []
    for i, text in docs:
        t = text or ""
        found = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        found.sort(key=lambda f: (f[1], kinds.index(f[0])))
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        out.append((i, *(sum(f[0] == k for f in found) for k in kinds), hashlib.sha256(base.encode()).hexdigest()))
    return out


def contamination(docs, items, window=13):
    windows = {}
    for name, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, names = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])]
        mark = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), mark, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def bm25(docs, asked, k=10):
    """For each asked id the scores of its best documents, best first; all distinct words of the row are asked for."""
    data = [(i, collections.Counter(ALNUM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n, df = len(data), collections.Counter(w for _, c in data for w in c)
    mean = sum(sum(c.values()) for _, c in data) / n
    idf = {w: math.log1p((n - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    out = {}
    for q, own in data:
        if q not in asked:
            continue
        scores = []
        for i, c in data:
            s = sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in own if w in c)
            if s > 0:
                scores.append((-round(s, 8), i))
        out[q] = sorted(s for s, _ in scores)[:k]
    return out


def alignment(docs, a_path, b_path):
    """docs: (id, text); rows as op12 returns them."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a, b, letters = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), {}
    a.encode_special_tokens = True
    for c in map(chr, range(400)):
        out = ByteLevel().decode([c])
        if len(out) == 1 and ord(out) < 128:
            letters[c] = ord(out)
    rest = [x for x in range(256) if x not in set(letters.values())]
    for x in rest:  # bytes outside ASCII: themselves where they are printable, the others follow in order
        if x >= 161 and x != 173:
            letters[chr(x)] = x
    free = [chr(c) for c in range(256, 324) if chr(c) not in letters]
    letters.update(zip(free, [x for x in rest if x not in set(letters.values())], strict=True))

    def bytes_b(piece):
        return bytes([int(piece[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def ends(pieces):
        at, out = 0, []
        for p in pieces:
            at += len(p)
            out.append(at)
        return out

    found = []
    for i, text in docs:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            pieces_a = [bytes(letters[c] for c in a.id_to_token(x)) for x in ids_a]
            pieces_b = [bytes_b(b.id_to_piece(x)) for x in ids_b]
            if b"".join(pieces_a) == b"".join(pieces_b) == (" " + text).encode():
                ends_a, ends_b = ends(pieces_a), ends(pieces_b)
                at_a = at_b = 0
                for cut in sorted(set(ends_a) & set(ends_b)):
                    one, other = ends_a.index(cut, at_a) + 1, ends_b.index(cut, at_b) + 1
                    groups.append((ids_a[at_a:one], ids_b[at_b:other]))
                    at_a, at_b = one, other
        found.append((i, groups))
    count = collections.Counter(p for _, gs in found for p in {(x, y) for g, h in gs for x in g for y in h})
    top = collections.defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, gs in found:
        links = collections.Counter((x, y) for g, h in gs for x in g for y in h)
        mark = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in gs)
        out.append(
            (i, sum(len(g) for g, _ in gs), sum(len(h) for _, h in gs), len(gs), sum(links.values()),
             sum(n for (x, y), n in links.items() if count[x, y] == top[x]), sum(n * count[p] for p, n in links.items()),
             hashlib.sha256(mark.encode()).hexdigest() if gs else "")
        )
    return out


def negatives(rows):
    """rows: (id, label, vector); rows as op11 returns them."""
    given = []
    for i, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        given.append((i, label, [math.floor(256 * x) for x in vector]))
    last = (lambda s, i: (-s, i is None, i or 0))
    out = []
    for k, (i, label, vector) in enumerate(given):
        if i is None or i % 50:
            continue
        scored = [(sum(x * y for x, y in zip(vector, other)), j, of) for m, (j, of, other) in enumerate(given) if m != k]
        scored.sort(key=lambda x: last(x[0], x[1]))
        for p, j, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 50 * p <= 100 * x[0] <= 95 * p][:3]
            out += [(i, j, r, f, p, s) for r, (s, f, _) in enumerate(fits, 1)]
    return out
