"""Plain scorers of one pair of texts, against which the column forms are tested."""

# fixed values: weights of the weighted ratio
TOKEN_WEIGHT = 0.95
WINDOW_WEIGHT = 0.9
LONG_WINDOW_WEIGHT = 0.6
WINDOW_FROM = 1.5
LONG_WINDOW_FROM = 8.0


def _positions(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def _lcs(masks: dict[str, int], size: int, other: str) -> int:
    full = (1 << size) - 1
    row = full
    for ch in other:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _score(common: int, total: int) -> float:
    return 200.0 * common / total if total else 0.0


def ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    return _score(_lcs(_positions(a), len(a), b), len(a) + len(b))


def ratio_to(text: str):
    """``ratio`` against one text, prepared once for many others."""
    masks, size = _positions(text), len(text)

    def score(other: str) -> float:
        return _score(_lcs(masks, size, other), size + len(other)) if text and other else 0.0

    return score


def window_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any window of the longer one.

    Windows are as long as the shorter text; those that hang over either end are cut.
    """
    if not a or not b:
        return 0.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(a, b) if len(a) < len(b) else _best_window(b, a)


def _best_window(short: str, long: str) -> float:
    n, masks = len(short), _positions(short)
    windows = (long[max(0, end - n) : end] for end in range(1, len(long) + n))
    return max(_score(_lcs(masks, n, w), n + len(w)) for w in windows if w)


def _token_parts(a: str, b: str) -> tuple[str, str, str, str, str]:
    ta, tb = set(a.split()), set(b.split())
    shared, only_a, only_b = (" ".join(sorted(s)) for s in (ta & tb, ta - tb, tb - ta))
    return shared, only_a, only_b, " ".join(sorted(a.split())), " ".join(sorted(b.split()))


def token_ratio(a: str, b: str) -> float:
    """Best ratio after sorting the words, with and without the shared ones."""
    shared, only_a, only_b, all_a, all_b = _token_parts(a, b)
    if not all_a or not all_b:
        return 0.0
    if shared and not (only_a and only_b):
        return 100.0
    best = ratio(all_a, all_b)
    if not shared:
        return max(best, ratio(only_a, only_b))
    head = len(shared)
    with_a, with_b = head + 1 + len(only_a), head + 1 + len(only_b)
    common = head + 1 + _lcs(_positions(only_a), len(only_a), only_b)
    return max(
        best,
        _score(common, with_a + with_b),
        _score(head, head + with_a),
        _score(head, head + with_b),
    )


def window_token_ratio(a: str, b: str) -> float:
    shared, only_a, only_b, all_a, all_b = _token_parts(a, b)
    if shared:
        return 100.0
    return max(window_ratio(all_a, all_b), window_ratio(only_a, only_b))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if stretch < WINDOW_FROM:
        return max(best, TOKEN_WEIGHT * token_ratio(a, b))
    weight = WINDOW_WEIGHT if stretch <= LONG_WINDOW_FROM else LONG_WINDOW_WEIGHT
    return max(
        best,
        weight * window_ratio(a, b),
        weight * TOKEN_WEIGHT * window_token_ratio(a, b),
    )
