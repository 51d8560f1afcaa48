"""String similarity on a 0-100 scale, as columns.

``ratio`` is the normalised insert/delete similarity ``200 * LCS / (len a + len b)``;
``weighted_ratio`` is the best of ratio, token and windowed forms with the usual weights.

The longest common subsequence is computed bit-parallel: a text's ``masks`` hold, for each
of its characters, the places where it stands, WORD of them to a ``bigint``. One row of the
classic table is then a few words, and each character of the other text costs a few integer
operations on them, with a carry from word to word. Everything runs in the JVM.

The builders take and give SQL text, since a tree of nested lambdas is far quicker to parse
than to build call by call.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: weights of the weighted ratio
TOKEN_WEIGHT = 0.95
WINDOW_WEIGHT = 0.9
LONG_WINDOW_WEIGHT = 0.6
WINDOW_FROM = 1.5
LONG_WINDOW_FROM = 8.0

BLANKS = r"(?U)[\s\x1C-\x1F]+"
WORD = 62  # places in a word: sums of two words stay within a long
NO_LONGS = "CAST(array() AS array<bigint>)"

_names = count()


def _name() -> str:
    return f"v{next(_names)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """``body(value)`` with the value computed once."""
    name = _name()
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def each(items: str, body: Callable[[str], str]) -> str:
    name = _name()
    return f"transform({items}, {name} -> {body(name)})"


def fold(items: str, start: str, step: Callable[[str, str], str]) -> str:
    done, item = _name(), _name()
    return f"aggregate({items}, {start}, ({done}, {item}) -> {step(done, item)})"


# --- longest common subsequence -----------------------------------------------------


def characters(text: str) -> str:
    return f"CASE WHEN length({text}) > 0 THEN split({text}, '') ELSE CAST(array() AS array<string>) END"


def masks(text: str) -> str:
    """What one text contributes to its longest common subsequences with others.

    -> struct(size, full, places, rows): ``places`` maps a character to its places for a
    text of one word, ``rows`` to its words for a longer one; ``full`` has all places set.
    """

    def places(part: str, kind: str) -> str:
        c, i = _name(), _name()
        bits = f"transform({part}, ({c}, {i}) -> IF({c} = {kind}, shiftleft(1L, {i}), 0L))"
        return fold(bits, "0L", lambda x, y: f"{x} | {y}")

    def of(chars: str) -> str:
        def words(make: Callable[[str], str]) -> str:
            """An array over the words, each made from its stretch of the text."""
            starts = f"sequence(0, size({chars}) - 1, {WORD})"
            return each(starts, lambda at: make(f"slice({chars}, {at} + 1, {WORD})"))

        def mapped(make: Callable[[str], str]) -> str:
            return let(f"array_distinct({chars})", lambda k: f"map_from_arrays({k}, {each(k, make)})")

        full = words(lambda part: f"shiftleft(1L, size({part})) - 1L")
        one = mapped(lambda kind: places(chars, kind))
        many = mapped(lambda kind: words(lambda part: places(part, kind)))
        return (
            f"named_struct('size', size({chars}), 'full', CASE WHEN size({chars}) > 0 THEN {full} END, "
            f"'places', CASE WHEN size({chars}) <= {WORD} THEN {one} END, "
            f"'rows', CASE WHEN size({chars}) > {WORD} THEN {many} END)"
        )

    return let(characters(text), of)


def lcs(mask: str, other: str) -> str:
    """Length of the longest common subsequence of a text, given by its masks, and another."""
    chars = f"split({other}, '')"

    def short(m: str) -> str:
        hits = each(chars, lambda c: f"coalesce(element_at({m}.places, {c}), 0L)")
        row = fold(
            hits, f"{m}.full[0]", lambda r, h: f"(({r} + ({r} & {h})) | ({r} - ({r} & {h}))) & {m}.full[0]"
        )
        return f"{m}.size - bit_count({row})"

    def long(m: str) -> str:
        def word(done: str, x: str) -> str:
            total = f"({x}.row + ({x}.row & {x}.hit) + {done}.carry)"
            kept = f"({total} | ({x}.row - ({x}.row & {x}.hit))) & {x}.full"
            return f"named_struct('carry', shiftright({total}, {WORD}), 'out', concat({done}.out, array({kept})))"

        def step(row: str, hit: str) -> str:
            r, h, p, f = _name(), _name(), _name(), _name()
            pairs = f"zip_with({row}, {hit}, ({r}, {h}) -> named_struct('row', {r}, 'hit', {h}))"
            zipped = (
                f"zip_with({pairs}, {m}.full, ({p}, {f}) -> "
                f"named_struct('row', {p}.row, 'hit', {p}.hit, 'full', {f}))"
            )
            start = f"named_struct('carry', 0L, 'out', {NO_LONGS})"
            return f"IF({hit} IS NULL, {row}, {fold(zipped, start, word)}.out)"

        left = fold(each(chars, lambda c: f"element_at({m}.rows, {c})"), f"{m}.full", step)
        return f"{m}.size - {fold(left, '0', lambda n, w: f'{n} + bit_count({w})')}"

    return let(
        mask,
        lambda m: f"CASE WHEN {m}.size = 0 OR length({other}) = 0 THEN 0 "
        f"WHEN {m}.rows IS NULL THEN {short(m)} ELSE {long(m)} END",
    )


def score(common: str, total: str) -> str:
    return f"IF({total} > 0, 200D * {common} / {total}, 0D)"


def common_length(a: str, b: str) -> str:
    """LCS of two texts; the masks are those of the shorter one."""
    pair = f"IF(length({a}) <= length({b}), named_struct('x', {a}, 'y', {b}), named_struct('x', {b}, 'y', {a}))"
    return let(pair, lambda p: let(masks(f"{p}.x"), lambda m: lcs(m, f"{p}.y")))


def _checked(a: str, b: str, plain: str) -> Column:
    return F.expr(f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {plain} END")


def ratio_column(a: str, b: str) -> Column:
    """``ratio`` of two text columns, given as SQL; NULL with a NULL, 0 with an empty text."""
    return _checked(a, b, score(common_length(a, b), f"(length({a}) + length({b}))"))


# --- weighted forms -----------------------------------------------------------------


def words(text: str) -> str:
    """The words of a text, sorted."""
    name = _name()
    return f"array_sort(filter(split({text}, r'{BLANKS}'), {name} -> {name} <> ''))"


def token_parts(a: str, b: str) -> str:
    """struct of texts: shared, only_a, only_b (distinct words, sorted), all_a, all_b."""
    sides = f"named_struct('a', {words(a)}, 'b', {words(b)})"
    return let(
        sides,
        lambda s: f"named_struct('shared', array_join(array_sort(array_intersect({s}.a, {s}.b)), ' '), "
        f"'only_a', array_join(array_sort(array_except({s}.a, {s}.b)), ' '), "
        f"'only_b', array_join(array_sort(array_except({s}.b, {s}.a)), ' '), "
        f"'all_a', array_join({s}.a, ' '), 'all_b', array_join({s}.b, ' '))",
    )


def _window_scores(pairs: str) -> str:
    """Best ratio of the shorter text of each pair against any window of the longer one.

    Windows are as long as the shorter text; those that hang over either end are cut. Of
    texts of equal length each one is the shorter in turn.
    """

    def best(s: str) -> str:
        n, size = f"length({s}.part)", f"length({s}.whole)"

        def window(m: str, end: str) -> str:
            begin = f"greatest({end} - {n}, 0)"
            cut = f"substr({s}.whole, {begin} + 1, least({end}, {size}) - {begin})"
            return let(cut, lambda w: score(lcs(m, w), f"({n} + length({w}))"))

        ends = f"sequence(1, {size} + {n} - 1)"
        most = let(masks(f"{s}.part"), lambda m: f"array_max({each(ends, lambda e: window(m, e))})")
        return f"IF({n} > 0 AND {size} > 0, {most}, 0D)"

    def sides(p: str) -> str:
        one = f"IF(length({p}.x) <= length({p}.y), array(named_struct('part', {p}.x, 'whole', {p}.y)), array())"
        two = f"IF(length({p}.y) <= length({p}.x), array(named_struct('part', {p}.y, 'whole', {p}.x)), array())"
        return f"concat({one}, {two})"

    return each(pairs, lambda p: f"array_max({each(sides(p), best)})")


def _token_ratio(t: str, all_common: str, only_common: str) -> str:
    """Best ratio after sorting the words, with and without the shared ones."""
    head, la, lb = (f"length({t}.{c})" for c in ("shared", "only_a", "only_b"))
    whole = score(all_common, f"(length({t}.all_a) + length({t}.all_b))")
    with_a, with_b = f"({head} + 1 + {la})", f"({head} + 1 + {lb})"
    shared = (
        f"greatest({whole}, {score(f'({head} + 1 + {only_common})', f'({with_a} + {with_b})')}, "
        f"{score(head, f'({head} + {with_a})')}, {score(head, f'({head} + {with_b})')})"
    )
    apart = f"greatest({whole}, {score(only_common, f'({la} + {lb})')})"
    return (
        f"CASE WHEN length({t}.all_a) = 0 OR length({t}.all_b) = 0 THEN 0D "
        f"WHEN {head} > 0 AND ({la} = 0 OR {lb} = 0) THEN 100D WHEN {head} = 0 THEN {apart} ELSE {shared} END"
    )


def weighted_ratio_column(a: str, b: str) -> Column:
    """The weighted ratio of two text columns; NULL with a NULL, 0 with an empty text."""

    def of(p: str) -> str:
        la, lb = f"length({p}.a)", f"length({p}.b)"
        pairs = (
            f"array(named_struct('x', {p}.a, 'y', {p}.b), named_struct('x', {p}.t.all_a, 'y', {p}.t.all_b), "
            f"named_struct('x', {p}.t.only_a, 'y', {p}.t.only_b))"
        )
        stretch = f"(greatest({la}, {lb}) / least({la}, {lb}))"
        weight = f"IF({stretch} <= {LONG_WINDOW_FROM}D, {WINDOW_WEIGHT}D, {LONG_WINDOW_WEIGHT}D)"
        common = each(pairs, lambda q: common_length(f"{q}.x", f"{q}.y"))
        plain = lambda c: score(f"{c}[0]", f"({la} + {lb})")
        near = let(
            common,
            lambda c: f"greatest({plain(c)}, {TOKEN_WEIGHT}D * {_token_ratio(f'{p}.t', f'{c}[1]', f'{c}[2]')})",
        )
        first = score(common_length(f"{p}.a", f"{p}.b"), f"({la} + {lb})")
        tokens = lambda w: f"IF(length({p}.t.shared) > 0, 100D, greatest({w}[1], {w}[2]))"
        far = let(
            _window_scores(pairs),
            lambda w: f"greatest({first}, {weight} * {w}[0], {weight} * {TOKEN_WEIGHT}D * {tokens(w)})",
        )
        return (
            f"CASE WHEN {la} = 0 OR {lb} = 0 THEN 0D WHEN {stretch} < {WINDOW_FROM}D THEN {near} ELSE {far} END"
        )

    pair = f"named_struct('a', {a}, 'b', {b}, 't', {token_parts(a, b)})"
    return _checked(a, b, let(pair, of))


def best_choice_column(value: str, choices: list[str]) -> Column:
    """``struct<choice, score>``: the first best of a short fixed list of choices."""
    literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = ", ".join(f"named_struct('at', {-i}, 'text', {literal(c)})" for i, c in enumerate(choices))
    text = f"coalesce({value}, '')"

    def scored(m: str) -> str:
        return each(
            f"array({listed})",
            lambda c: f"named_struct('score', {score(lcs(m, f'{c}.text'), f'({m}.size + length({c}.text))')}, "
            f"'at', {c}.at, 'choice', {c}.text)",
        )

    top = let(masks(text), lambda m: f"array_max({scored(m)})")
    return F.expr(let(top, lambda t: f"named_struct('choice', {t}.choice, 'score', {t}.score)"))


def ratio(a: str, b: str) -> float:
    """``ratio`` of two short names on the driver."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = row
        row = [0]
        for j, y in enumerate(b):
            row.append(left[j] + 1 if x == y else max(left[j + 1], row[j]))
    return 200.0 * row[-1] / (len(a) + len(b)) if a and b else 0.0
