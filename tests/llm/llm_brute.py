"""Plain versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(A_Z))


def windows_of(items, size=10):
    found = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            found[tuple(words[i : i + n])].add("" if item is None else str(item))
    return found


def contamination(text, windows):
    words, hit, items = alnum_words(text), set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            which = windows.get(tuple(words[i : i + n]))
            if which:
                hit.update(range(i, i + n))
                items |= which
    return len(words), hit, items


def shingles(text):
    words = WORD.findall((text or "").translate(A_Z))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows):
    """Smallest id linked to each id, from (id, text) rows."""
    sets = defaultdict(list)
    for i, text in rows:
        if i is not None:
            sets[i].append(shingles(text))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]
            ):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(x) <= 255 for x in m.split(".")),
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m)),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
}


def pii(text):
    found = []
    for rank, (kind, (pattern, valid)) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(m.group()):
                found.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, triple in enumerate(zip(words, words[1:], words[2:])):
        if triples[triple] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def word_counts(rows, one_in):
    """Counts of words of (id, text) rows, a letter lost in one of so many pairs."""
    counts = Counter()
    for i, text in rows:
        for run in LETTERS.findall(text or ""):
            word = run.translate(A_Z)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % one_in == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def variants(counts):
    """form, root, n, number of near words and form's n of each word."""
    lost = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            lost[i, w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for same in lost.values():
        for w in same:
            near[w] |= same - {w}
    for w in counts:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1 :]) in counts:
                near[w].add(short)
                near[short].add(w)
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= 5 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, tampered=False):
    values = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    if tampered and values[4] is not None:
        values[4] = values[4].translate(A_Z)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def merkle(rows):
    """leaf, subroot, root, proof and folded root of each id; ids are unique."""
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        groups[row["lang"]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([leaf(r) for r in groups[g]]) for g in names]
    top = levels([t[-1][0] for t in trees])

    def siblings(tree, i):
        for level in tree[:-1]:
            begin = i // 8 * 8
            yield level[begin:i], level[i + 1 : begin + 8]
            i //= 8

    found = {}
    for g, (name, tree) in enumerate(zip(names, trees)):
        for i, row in enumerate(groups[name]):
            path = [*siblings(tree, i), *siblings(top, g)]
            folded = leaf(row, zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0)
            for left, right in path:
                folded = _h(*left, folded, *right)
            proof = _h(*(d for left, right in path for d in left + right))
            found[row["doc_id"]] = (tree[0][i], tree[-1][0], top[-1][0], proof, folded)
    return found


def pieces(text, size):
    """Words of a text, long ones in pieces."""
    return [w[i : i + size] for w in WORD.findall(text) for i in range(0, len(w), size)]
