"""Plain reference versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

BLANK_WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def kept_bytes(texts, span):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - span + 1):
            if counts[d[i : i + span]] > 1:
                gone[i : i + span] = [True] * span
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def shingle_set(text, k=5):
    words = re.findall(BLANK_WORD, lower(text))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near_components(rows, percent=85):
    """{doc_id: component} of (doc_id, text)."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if i < j and shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def contaminated(text, items, size=13):
    """(n_words, n_hit, n_items, items_sha256, contaminated)."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words, hit, found = re.findall(pattern, lower(text)), set(), set()
    for item, body in items:
        own = re.findall(pattern, lower(body))
        n = min(size, len(own))
        for s in range(len(own) - n + 1 if own else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[s : s + n]:
                    hit.update(range(at, at + n))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(BLANK_WORD, text)
    lines = [x for x in text.split("\n") if re.search(BLANK_WORD, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def best_fit(lengths, capacity):
    """Rows of items, searched one by one."""
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in range(len(rows)) if room[r] >= lengths[i]]
        if fits:
            r = min(fits, key=lambda r: room[r])
        else:
            r = len(rows)
            rows.append([])
            room.append(capacity)
        rows[r].append(i)
        room[r] -= lengths[i]
    return rows


def exact_groups(rows):
    """Sorted (doc_id, keep_id, group_size, sha256) of (doc_id, text)."""
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(rows):
    """Sorted nodes of (conv_id, turn, role, text)."""
    import zlib

    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    whole = {}
    for c, v in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole[c] = said.get(base, [])[:h] + v[h:]
    members, kids = {}, {}
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members.setdefault(tuple(whole[c][:d]), []).append(c)
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in ids if len(whole[c]) == len(path))
        out.append((
            ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), len(kids.get(path, [])),
            sum(p not in kids for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


class Aligner:
    """Two tokenizers on whole texts, token by token."""

    def __init__(self, byte_level, pieces):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        alphabet = {chr(b) if b in visible else chr(next(hidden)): b for b in range(256)}
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab().items() if i < 50256}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def one(self, text):
        """(n_a, n_b, n_groups, links, digest) or None."""
        if not text:
            return None
        sides = []
        for ids, spell in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes.get), (self.b.encode(text), self.b_bytes)):
            spelled, end, ranges = [spell(i) for i in ids], 0, []
            for i, x in zip(ids, spelled):
                ranges.append((end, end + len(x), i))
                end += len(x)
            if b"".join(spelled) != (" " + text).encode():
                return None
            sides.append(ranges)
        common, groups, low = sorted({r[1] for r in sides[0]} & {r[1] for r in sides[1]}), [], 0
        links = []
        for high in common:
            inside = [[r for r in side if low <= r[0] and r[1] <= high] for side in sides]
            groups.append("|".join(",".join(str(r[2]) for r in side) for side in inside))
            links += [(x[2], y[2]) for x in inside[0] for y in inside[1] if max(x[0], y[0]) < min(x[1], y[1])]
            low = high
        return len(sides[0]), len(sides[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def rows(self, rows):
        told = [(i, self.one(t)) for i, t in rows]
        counts = Counter(p for _, x in told if x for p in set(x[3]))
        best = {a: max(n for (x, _), n in counts.items() if x == a) for a, _ in counts}
        none = (0, 0, 0, 0, 0, 0, "")
        out = [
            (i, *((x[0], x[1], x[2], len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) if x else none))
            for i, x in told
        ]
        return sorted(out, key=repr)
