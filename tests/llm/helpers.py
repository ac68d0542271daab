"""Plain brute-force versions."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, texts, lang="en", source="s", first=0):
    return spark.createDataFrame([(first + i, t, lang, source, len(t) if t is not None else None) for i, t in enumerate(texts)], DOCS)


def save(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def shingles(text, n):
    w = words(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(sets, percent=80):
    """{id: smallest id reachable}; sets by id."""
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}
