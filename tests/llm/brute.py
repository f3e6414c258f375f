"""The operators' results by plain Python, for small tables of (doc_id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# Names that the operators use for columns of their own.
CLASHING = (
    "row",
    "block",
    "leaks",
    "counts",
    "kept",
    "limits",
    "fingerprint",
    "text_hash",
    "n_words",
    "n_removed",
    "n_bytes",
    "n_spans",
    "n_tokens",
    "shard",
    "slot",
    "record",
    "bucket",
    "first",
    "n",
    "b",
)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def in_order(docs):
    """(position in the table, id, text) by id, null ids last, then position."""
    rows = [(k, i, t or "") for k, (i, t) in enumerate(docs)]
    return sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))


def covered(tokens, width, seen):
    gone = set()
    for k in range(len(tokens) - width + 1):
        window = tuple(tokens[k : k + width])
        if window in seen:
            gone.update(range(k, k + width))
        seen.add(window)
    return gone


def substring(docs, width=20):
    """Per row of the table: (id, words, removed, text left)."""
    seen, out = set(), {}
    for place, id_, text in in_order(docs):
        words = WORD.findall(text)
        gone = covered(words, width, seen)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[place] = (id_, len(words), len(gone), sha(kept))
    return sorted(out.values(), key=repr)


def suffix(docs, width=100):
    seen, out = set(), {}
    for place, id_, text in in_order(docs):
        raw = text.encode()
        gone = covered(raw, width, seen)
        spans = sum(k - 1 not in gone for k in gone)
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        out[place] = (id_, len(raw), len(gone), spans, sha(kept))
    return sorted(out.values(), key=repr)


def leaks(docs, items, width=10):
    windows = {}
    for id_, text in items:
        words = ALNUM.findall(lower(text))
        for k in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + width]), set()).add("" if id_ is None else str(id_))
    out = []
    for id_, text in docs:
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(words) - length + 1):
                if own := windows.get(tuple(words[k : k + length])):
                    hit.update(range(k, k + length))
                    found |= own
        out.append((id_, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=repr)


def counts(docs):
    out = []
    for id_, text in docs:
        text = text or ""
        words = WORD.findall(text)
        n = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        twice = {
            k + j for k in range(len(words) - 4) if n[tuple(words[k : k + 5])] > 1 for j in range(5)
        }
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
        chars = sum(map(len, words))
        out.append((id_, len(words), chars, symbols, again, len(twice), failed))
    return sorted(out, key=repr)


def fingerprint(text, shingle=4):
    words = WORD.findall(lower(text))
    n = max(1, len(words) - shingle + 1) if words else 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[k : k + shingle]).encode(), 42) for k in range(n)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def near(docs, max_bits=4):
    """(id, fingerprint, component) of each row, and the least id of each component."""
    prints = [fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= max_bits:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {find(k): None for k in range(len(docs))}
    for k, (id_, _) in enumerate(docs):
        if id_ is not None:
            own = least[find(k)]
            least[find(k)] = id_ if own is None else min(id_, own)
    rows = [(id_, f"{prints[k]:016x}", least[find(k)]) for k, (id_, _) in enumerate(docs)]
    return sorted(rows, key=repr), sorted(least.values(), key=repr)


def search(docs, items, k=10):
    """(item, rank, doc_id, score); equal scores by id, null ids last."""
    found = [(i, Counter(ALNUM.findall(lower(t)))) for i, t in docs]
    found = [(i, c, c.total()) for i, c in found if c]
    total = sum(n for _, _, n in found)
    df = Counter(w for _, c, _ in found for w in c)
    out = []
    for item, text in items:
        asked = set(ALNUM.findall(lower(text))) & set(df)
        weight = {w: math.floor(1000 * math.log((2 * len(found) + 2) / (2 * df[w] + 1))) for w in asked}
        scores = []
        for doc, c, n in found:
            m = 10 + 90 * n * len(found) // total
            score = sum(weight[w] * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in asked if c[w])
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def variant_words(docs, noise=199, least=5):
    """word -> count of the altered letter runs of at least six letters."""
    counts = Counter()
    for id_, text in docs:
        for word in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = lower(word)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{word}".encode())
            if h % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def variants(words, ratio=5):
    """(word, form, root, n, n_near, form_n) by the words that each word less a letter gives."""
    less = {}
    for word in words:
        for k in range(len(word)):
            less.setdefault((k, word[:k] + word[k + 1 :]), set()).add(word)
    near = {w: set() for w in words}
    for (_, rest), own in less.items():
        for w in own:
            near[w] |= own - {w}
        if rest in words:
            near[rest] |= own
            for w in own:
                near[w].add(rest)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def shingle_set(text, width=5):
    words = WORD.findall(lower(text))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def similar(docs, percent=85, width=5):
    """(id, set size, component, kept) of each row."""
    sets = [shingle_set(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (id_, _) in enumerate(docs):
        if id_ is not None:
            least[find(k)] = min(least.get(find(k), id_), id_)
    return sorted(
        ((i, len(sets[k]), least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(docs)), key=repr
    )
