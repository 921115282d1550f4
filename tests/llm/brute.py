"""Plain versions of the operators, for small tables."""

import hashlib
import re

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return SPACE.findall(lower)


def shingle_set(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_classes(docs):
    """{doc_id: (set size, least doc_id reachable)} for distinct ids."""
    sets = {i: shingle_set(t) for i, t in docs}
    at = {i: i for i in sets}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def one_edit(a, b):
    if b"".join(a) == b"".join(b):  # other white space
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def repeated_lines(docs, least=8):
    """{(doc_id, line number): near} of the lines that go."""
    lines = sorted((i, k, tuple(words(x))) for i, t in docs if t is not None for k, x in enumerate(t.split("\n")))
    lines = [x for x in lines if x[2]]
    first, out = {}, {}
    for i, k, w in lines:
        first.setdefault(w, (i, k))
    near = {
        w for w, f in first.items()
        if len(w) >= least and any(g < f and len(v) >= least and one_edit(v, w) for v, g in first.items() if v != w)
    }
    for i, k, w in lines:
        if w in near or (i, k) > first[w]:
            out[i, k] = w in near
    return out


SECRETS = [
    ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]
PRIVATE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {
        "assign": lambda: len(m[2]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32,
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def spans(text, rules):
    """(list of base spans, sha256 of their text)."""
    found = sorted(
        (m.start(), k, m.end(), kind) for k, (kind, rx) in enumerate(rules) for m in rx.finditer(text or "") if valid(kind, m)
    )
    shown = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
    return shown, hashlib.sha256(shown.encode()).hexdigest()
