"""Plain versions of the operators, for small tables."""

SMALL = "/root/testdata/sf0.001"


def near_components(rows: dict[int, str | None], words: int, similarity: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), by comparing all pairs that share a shingle."""
    sets, holders = {}, {}
    for doc, text in rows.items():
        found = (text or "").encode().lower().split()
        size = min(words, len(found))
        last = len(found) - size + 1 if found else 0
        sets[doc] = {tuple(found[i : i + size]) for i in range(last)}
        for shingle in sets[doc]:
            holders.setdefault(shingle, []).append(doc)
    root = {doc: doc for doc in rows}

    def find(doc: int) -> int:
        while root[doc] != doc:
            root[doc] = root[root[doc]]
            doc = root[doc]
        return doc

    for doc, own in sets.items():
        common: dict[int, int] = {}
        for shingle in own:
            for other in holders[shingle]:
                if other > doc:
                    common[other] = common.get(other, 0) + 1
        for other, n in common.items():
            if 100 * n >= similarity * (len(own) + len(sets[other]) - n):
                one, two = sorted((find(doc), find(other)))
                root[two] = one
    return {doc: (len(sets[doc]), find(doc)) for doc in rows}


def kneser_ney(counts: dict[str, int], order: int) -> dict[str, float]:
    """Interpolated modified Kneser-Ney probability of each n-gram of one group."""
    levels = [dict(counts)]
    for _ in range(order - 1):
        shorter: dict[str, int] = {}
        for gram in levels[-1]:
            shorter[gram[1:]] = shorter.get(gram[1:], 0) + 1
        levels.append(shorter)
    lower: dict[str, float] = {}
    for size, level in enumerate(reversed(levels), start=1):
        n = [sum(c == i for c in level.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        discounts = []
        for i in (1, 2, 3):
            d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0
            discounts.append(d if 0 < d < i else i / 2)
        total: dict[str, int] = {}
        freed: dict[str, float] = {}
        for gram, c in level.items():
            context = gram[: size - 1]
            total[context] = total.get(context, 0) + c
            freed[context] = freed.get(context, 0) + discounts[min(c, 3) - 1]
        lower = {
            gram: (
                c
                - discounts[min(c, 3) - 1]
                + freed[gram[: size - 1]] * (lower[gram[1:]] if size > 1 else 1 / (len(level) + 1))
            )
            / total[gram[: size - 1]]
            for gram, c in level.items()
        }
    return lower


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, from their definitions."""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(
        1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i]
    )
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def quality(rows: list[tuple], order: int, below: float, above: float, least_spread: float) -> dict:
    """doc_id -> (base counts, base_failed, log perplexity, kept) for (doc_id, lang, text)."""
    import math
    import re
    from statistics import median_low

    def grams(word: str) -> list[str]:
        spelled = "\x02" * (order - 1) + word + "\x03"
        return [spelled[i : i + order] for i in range(len(word) + 1)]

    counts: dict[str, dict[str, int]] = {}
    for _, lang, text in rows:
        own = counts.setdefault(lang or "", {})
        for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            for gram in grams(word):
                own[gram] = own.get(gram, 0) + 1
    models = {lang: kneser_ney(own, order) for lang, own in counts.items() if own}
    found = {}
    for doc, lang, text in rows:
        base = base_counts(text or "")
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        total = 0.0
        for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            total -= sum(math.log(models[lang or ""][g]) for g in grams(word))
        found[doc] = [lang or "", base, failed, total / max(base[0], 1)]
    bands = {}
    for lang in {f[0] for f in found.values()}:
        values = [f[3] for f in found.values() if f[0] == lang and not f[2]]
        if values:
            middle = median_low([round(v, 3) for v in values])
            spread = max(least_spread, median_low([round(abs(v - middle), 3) for v in values]))
            bands[lang] = middle - below * spread, middle + above * spread
    return {
        doc: (base, failed, value, not failed and bands[lang][0] <= value <= bands[lang][1])
        for doc, (lang, base, failed, value) in found.items()
    }


def merged(text: str, ids: dict[str, int], scores: dict[str, float]) -> list[str]:
    """BPE by its definition: join the best pair, the first of equals, until none is left."""
    symbols = list(text)
    while True:
        best = None
        for i in range(len(symbols) - 1):
            piece = symbols[i] + symbols[i + 1]
            if piece in ids and (best is None or scores[piece] > scores[symbols[best] + symbols[best + 1]]):
                best = i
        if best is None:
            return symbols
        symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]


def mix(sources: dict[int, str], exponent: float, total: int, block_rows: int) -> dict[int, int]:
    """doc_id -> position: at each slot the released block with the earliest deadline."""
    from hashlib import md5

    queues: dict[str, list[int]] = {}
    for doc in sorted(sources, key=lambda d: (md5(str(d).encode()).hexdigest(), d)):
        queues.setdefault(sources[doc], []).append(doc)
    shares = {s: len(queue) ** exponent for s, queue in queues.items()}
    parts = {s: max(1, int(share * total / sum(shares.values()) + 0.5)) for s, share in shares.items()}
    q = sum(parts.values())
    done = dict.fromkeys(parts, 0)
    order: list[int] = []
    slot = 0
    while len(order) < len(sources):
        released = [s for s in parts if done[s] * q // parts[s] <= slot]
        if released:
            next_ = min(released, key=lambda s: (-(-(done[s] + 1) * q // parts[s]), s))
            order += queues[next_][done[next_] * block_rows : (done[next_] + 1) * block_rows]
            done[next_] += 1
        slot += 1
    return {doc: place for place, doc in enumerate(order)}
