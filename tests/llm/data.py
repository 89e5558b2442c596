"""Small documents with the awkward cases, and plain Python versions of the operators."""

import random
import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(rng, n, letters="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus(seed=0):
    """Rows with nulls, empty and long texts, copies, near-copies, shared passages and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(60, 160)) for _ in range(12)]
    passage = prose(rng, 70)
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    for k in range(12):  # near-copies of one text, in a chain of edits
        w = base[0].split()
        for _ in range(k // 3):
            w[rng.randrange(len(w))] = "edited"
        rows.append((20 + k, " ".join(w), "en", "hot", 1))
    for k in range(10):
        rows.append((40 + k, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "fr", "hot", 1))
    rows += [(60, None, None, None, None), (61, "", "en", "s1", 0), (62, " \n\t ", "de", "s1", 4), (63, "one", "en", "s2", 3), (64, "one two", "en", "s2", 7), (65, "ONE two", "en", "s2", 7)]
    rows += [(66, prose(rng, 6000), "es", "hot", 1), (67, base[1], "en", "s0", 1), (67, base[1], "en", "s0", 1)]
    rows += [(68, "x" * 700, "xx", "s9", 700), (69, "é ñ <|endoftext|> ǅ ́a 漢字 Σας İ $$$ !!! \x1c it's", "fr", "s9", 1), (70, ("same line here\n" * 40), "en", "s1", 1)]
    return rows


def shingle_set(text, n):
    w = WORDS.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(sets, threshold):
    """Smallest id per id, by comparing all pairs."""
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def removed(texts, length):
    """Covered bytes of each text: where a string of ``length`` bytes occurs elsewhere."""
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        cover = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = [True] * length
        out.append(cover)
    return out
