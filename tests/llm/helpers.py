"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash

DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "row bigint, key string, name string, id bigint, fp bigint")


def docs_frame(spark, rows, schema=DOCS):
    """Documents with extra columns whose names clash with the operators' working columns."""
    full = [(i, t, lang, src, None if t is None else len(t), 7, "k", None, 3, None) for i, t, lang, src in rows]
    return spark.createDataFrame(full, schema)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward(seed=0, n=60):
    """(doc_id, text, lang, source): nulls, empties, copies, near copies, a long text, repeated rows, null ids."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(1, 80)) for _ in range(n)]
    rows = [(i, t, rng.choice(["en", "de"]), f"s{i % 12}") for i, t in enumerate(base)]
    k = n
    for t in base[:8]:
        for _ in range(3):
            rows.append((k, t, "en", None))
            k += 1
    for t in base[8:20]:  # near copies
        w = t.split(" ")
        w[rng.randrange(len(w))] = "zzz"
        rows.append((k, " ".join(w), None, "s1"))
        k += 1
    rows += [(k, None, None, None), (k + 1, "", "en", "s2"), (k + 2, " \n\t ", "en", "s2"), (k + 3, None, "de", "s3"),
             (k + 4, sentence(rng, 30_000), "en", "s4"), (None, base[0], "en", "s5"), (None, None, None, None),
             (k + 5, "1234 --- !!", "en", "s6")]
    rows += [rows[0], rows[0]]
    return rows


def brute_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, linked):
    """Smallest index of each value's component; linked(a, b) tells whether two values are."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()
