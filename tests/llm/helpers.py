"""Small tables and plain, slow versions of the operators."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns whose names the operators use themselves
CLASHING = ("part int, kind string, key long, fp long, word string, score double, text_ string, row long, bucket int, "
            "others string, kept string, spans int, kept_bytes int, removed_spans int, first_id long, size int")


def documents(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    for field in CLASHING.split(", "):
        name, kind = field.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def table_texts(sf_dir, name="documents"):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def brute_dedup(rows, size):
    """{doc_id: (kept bytes, runs)} of (doc_id, text) rows with distinct ids."""
    first = {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            first.setdefault(b[p:p + size], i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if first[b[p:p + size]] < i:
                gone[p:p + size] = b"\1" * size
        runs = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (bytes(x for x, g in zip(b, gone, strict=True) if not g), runs)
    return out


def brute_fingerprint(text, words=4):
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [parts] if len(parts) < words else [parts[i:i + words] for i in range(len(parts) - words + 1)]
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(edges, nodes):
    """{node: smallest node reachable}."""
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        stack = [n] if n not in out else []
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = n
                stack += near[x]
    return out


def passages(seed, n_docs, alphabet="ab é", longest=200):
    """Texts made of shared, sometimes altered passages and noise."""
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [noise(rng.randrange(40, longest)) for _ in range(12)]
    out = []
    for _ in range(n_docs):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(shared)
                if rng.random() < 0.3:
                    k = rng.randrange(len(p))
                    p = p[:k] + "X" + p[k + 1:]
                parts.append(p[rng.randrange(0, 20):])
            elif kind < 0.6:
                parts.append("a" * rng.randrange(0, 150))
            else:
                parts.append(noise(rng.randrange(0, 120)))
        out.append("".join(parts))
    return out
