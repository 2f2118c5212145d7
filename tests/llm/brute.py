"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def remainder(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def base_scores(rows):
    """(doc_id, text) to rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    train = Counter()
    for doc_id, text in rows:
        if remainder(doc_id, 10):
            train.update([*words(text), None])
    total, distinct, out = sum(train.values()), len(train), []
    for doc_id, text in rows:
        tokens = [*words(text), None]
        base = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out.append((doc_id, remainder(doc_id, 10) == 0, len(tokens), sum(train[t] > 0 for t in tokens), total, base))
    return out


def segmentations(word, table):
    """The log of the summed probability of all ways to cut a word; recursion over first pieces."""
    if not word:
        return 0.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in table:
            rest = segmentations(word[k:], table)
            total += math.exp(table[word[:k]] + rest) if rest > -math.inf else 0.0
    return math.log(total) if total else -math.inf


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def fingerprint(text):
    parts = words(text)
    if not parts:
        return 0
    shingles = [" ".join(parts[k:k + 4]) for k in range(max(1, len(parts) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, distance):
    """For each position the smallest position that links reach."""
    bits = np.array(fingerprints, dtype=np.uint64)
    label = np.arange(len(bits))
    near = [np.flatnonzero(np.bitwise_count(bits ^ b) <= distance) for b in bits]
    changed = True
    while changed:
        new = np.array([label[n].min() for n in near])
        changed = bool((new != label).any())
        label = new
    return label.tolist()


def removed(texts, size):
    """Of each text the runs [first, end) covered by strings of ``size`` bytes that start elsewhere too."""
    octets = [(t or "").encode() for t in texts]
    starts = Counter(b[i:i + size] for b in octets for i in range(len(b) - size + 1))
    out = []
    for b in octets:
        runs = []
        for i in range(len(b) - size + 1):
            if starts[b[i:i + size]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + size
                else:
                    runs.append([i, i + size])
        out.append(runs)
    return out


def kept_digest(text, runs):
    octets, at, out = (text or "").encode(), 0, b""
    for first, end in runs:
        out, at = out + octets[at:first], end
    return hashlib.sha256(out + octets[at:]).hexdigest()


def benchmark_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def overlap(text, item, window=13, share=0.8):
    """Whether some ``window`` tokens in a row agree in ``share`` of their places, wherever they lie."""
    a, b = benchmark_words(text), benchmark_words(item)
    wide = min(window, len(b))
    need = math.ceil(wide * share - 1e-9)
    for lie in range(-len(b), len(a) + 1):
        equal = [0 <= k + lie < len(a) and a[k + lie] == b[k] for k in range(len(b))]
        if any(sum(equal[s:s + wide]) >= need for s in range(len(b) - wide + 1)):
            return True
    return False
