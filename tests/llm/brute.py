"""Plain versions of the operators, one document at a time, that results are held against."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


_bpe = []


def token_ids(text):
    if not _bpe:
        _bpe.append(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    return _bpe[0].encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def quality(text):
    words = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def shingles(text, size=3):
    words = SPACED.findall(lower_ascii(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def similar_groups(docs, percent=90):
    """doc_id -> (size of its set, smallest reachable doc_id), every pair compared."""
    sets = {d: shingles(t) for d, t in docs}
    found = components_of(sets, percent)
    return {d: (len(sets[d]), found[d]) for d in sets}


def decontamination(docs, items, window=13):
    patterns = {}
    for item, text in items:
        w = LETTERED.findall(lower_ascii(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    lengths = {len(p) for p in patterns}
    out = {}
    for d, text in docs:
        w, hit, found = LETTERED.findall(lower_ascii(text)), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                ids = patterns.get(tuple(w[i : i + n]))
                if ids:
                    found |= ids
                    hit.update(range(i, i + n))
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def token_files(docs):
    out, start = {}, 0
    for d, text in sorted(docs):
        ids = token_ids(text)
        out[d] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def conversations(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(conv, []).append((role, text or ""))
    return {
        c: (
            len(turns),
            sha("".join(f"{r}\n{t}\n" for r, t in turns)),
            sum(len(t) for r, t in turns if r == "assistant"),
            sha("".join(t for r, t in turns if r == "assistant")),
        )
        for c, turns in out.items()
    }


def pieces(docs, longest=4096):
    out = {}
    for d, text in docs:
        ids = token_ids(text)
        for k, at in enumerate(range(0, len(ids), longest)):
            part = ids[at : at + longest]
            out[d, k] = (at, len(part), crc(part))
    return out


def components_of_links(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        lo, hi = sorted((root(u), root(v)))
        parent[hi] = lo
    return {x: root(x) for x in list(parent)}


def components_of(sets, percent):
    """doc -> smallest reachable doc; every pair compared."""
    ids = sorted(sets)
    links = [(d, d) for d in ids]
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return components_of_links(links)
