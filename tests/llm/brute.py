"""Plain single-machine versions of the operators' contracts."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def benchmark_hits(docs, items):
    """{doc: (n_words, n_hit, items)} for docs and items as {id: text}."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - 9, 1 if w else 0)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if x := windows.get(tuple(w[i : i + n])):
                    found |= x
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def simhash(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text or "").encode())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints, radius=4):
    """Least index reachable by links, for each fingerprint."""
    fp = np.array(prints, dtype=np.uint64)
    near, label = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius, np.arange(len(fp))
    while True:
        new = np.array([label[row].min() for row in near], dtype=np.int64)
        if np.array_equal(new, label):
            return label
        label = new


def passages(docs, length=50):
    """(id, n_bytes, n_removed, spans, kept) for rows (id, text)."""
    rows, first = [(i, (t or "").encode()) for i, t in docs], {}
    for i, b in rows:
        for k in range(len(b) - length + 1 if i is not None else 0):
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1 if i is not None else 0):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


PERSONAL = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def personal(text):
    out = []
    for kind, pattern in enumerate(PERSONAL):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            luhn = sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def address(url, rules):
    """host, path, rule and its verdict."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host, fits = lower(host), []
    for verdict, rule in rules:
        name, _, begin = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + begin):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))
