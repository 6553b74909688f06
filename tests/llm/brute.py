"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, num=3, den=4):
    """(n_shingles, component) of each (doc_id, text), by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {i + d for places in at.values() if len(places) > 1 for i in places for d in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(said.encode()).hexdigest()


def tiles(item, doc, least=5):
    """Greedy string tiling by trying every pair of places, longest common run first."""
    a, b, out = [True] * len(item), [True] * len(doc), []
    least = min(least, len(item))
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and a[i + n] and b[j + n] and item[i + n] == doc[j + n]:
                    n += 1
                if n >= max(1, least) and (best is None or n > best[2]):
                    best = (i, j, n)
        if not best:
            return out
        out.append(best)
        i, j, n = best
        a[i:i + n] = [False] * n
        b[j:j + n] = [False] * n


def conversations(rows):
    """(n_turns, turns digest, loss length, loss digest) of each conversation."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, said in turns.items():
        said.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in said)
        loss = "".join(t for *_, r, t in said if r == "assistant")
        out[conv] = len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def alignments(rows, json_path, model_path):
    """Digest of each (doc_id, text), from whole texts: every byte knows its token on either side."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(json_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=model_path)
    shown = {chr(i): i for i in range(256) if 33 <= i < 127 or 161 <= i < 173 or i > 173}
    shown |= {chr(256 + k): i for k, i in enumerate(i for i in range(256) if chr(i) not in shown)}
    found, counts = [], collections.Counter()
    for doc, text in rows:
        whole = (" " + text).encode() if text else b""
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        parts = [[bytes(shown[c] for c in a.id_to_token(i)) for i in ids[0]],
                 [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if any(b"".join(p) != whole for p in parts):
            ids, whole = [[], []], b""
        owner = [[i for i, p in enumerate(side) for _ in p] for side in parts]
        links, spelled, group = [], [], [[], []]
        for at in range(len(whole)):
            x, y = owner[0][at], owner[1][at]
            new = [at == 0 or own[at] != own[at - 1] for own in owner]
            if new[0] and new[1] and at:
                spelled.append(group)
                group = [[], []]
            for side, token in ((0, x), (1, y)):
                if new[side]:
                    group[side].append(str(ids[side][token]))
            if new[0] or new[1]:
                links.append((ids[0][x], ids[1][y]))
        spelled = ["|".join(map(",".join, g)) for g in spelled + [group]] if whole else []
        counts.update(set(links))
        found.append((doc, *ids, spelled, links))
    highest = collections.Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return [(doc, len(x), len(y), len(g), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for doc, x, y, g, links in found]


def vocabulary(rows):
    """Counts of words of at least 7 letters, seen twice or more, of (doc_id, text)."""
    seen = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """Whether exactly one code point was inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts, ratio=10):
    """(word, n, n_near, form, form_n, root) by comparing all pairs of words."""
    near = {w: [] for w in counts}
    for a in counts:
        for b in counts:
            if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items())


def language_grams(rows, orders, least_share, least_contrast):
    """The n-grams of each language, as strings with "|" for a word end, from (text, lang)."""
    seen = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            seen[lang].update(grams(text, orders))
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in seen.items()}
    most = collections.Counter()
    for each in share.values():
        for g, x in each.items():
            most[g] = max(most[g], x)
    return {lang: {g for g, x in each.items() if x >= least_share and x >= least_contrast * most[g]} for lang, each in share.items()}


def grams(text, orders):
    out = []
    for word in re.findall(r"\w+", "".join(c if c.isalpha() else " " for c in text)):
        word = "|" + "".join(c.lower() if len(c.lower()) == 1 else c for c in word) + "|"
        out += [word[i:i + k] for k in orders for i in range(len(word) - k + 1)]
    return out
