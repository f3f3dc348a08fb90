"""The JSON walkers as Spark SQL expression text.

:mod:`shoal.functions.jsonfn` documents the semantics and hands the text to Spark in one
``F.expr`` call, which Spark parses in milliseconds; built through the Column API every
node would be a round trip to the JVM.  All builders take and return SQL text; lambda
variables get fresh names so nested walkers never capture each other's.

A walker is unrolled for ``depth`` levels, each a nested higher-order function.  An object
below them is written as JSON text once and searched (``find_below``) or changed (``rebuild_below``)
there in one pass, whatever its depth and with the same result.  ``depth`` is thus only a matter
of speed.  In a plain text, one without escapes, regular expressions run along the tokens and
change the few that differ.  Any other is cut into its tokens (``tokens``), which are looked
at and written out one by one.  Where arrays nest deeper than a token may (``ARRAYS``), a flat
entry list (``entry_list``) takes their place.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Mapping

DOC_TYPE = "MAP<STRING, VARIANT>"
NULL_STR = "CAST(NULL AS STRING)"

_ids = itertools.count()


def fresh(prefix: str) -> str:
    return f"_{prefix}{next(_ids)}"


def lit(value: str) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: str, body) -> str:
    """``value`` evaluated once, bound to a fresh name inside ``body(name)``."""
    v = fresh("v")
    return f"get(transform(array({value}), {v} -> {body(v)}), 0)"


def as_object(value: str) -> str:
    return f"try_cast({value} AS {DOC_TYPE})"


def parse_doc(text: str) -> str:
    return as_object(f"try_parse_json({text})")


def to_variant_text(value: str) -> str:
    return f"CAST(CAST({value} AS STRING) AS VARIANT)"


def _names(keys: Iterable[str]) -> str:
    return ", ".join(lit(k) for k in keys)


# Kinds of an entry list's items: an entry not looked at yet, one that is no object, and the
# two ends of an object that is.
_NEW, _VALUE, _BEGIN, _END = (f"{k}Y" for k in range(4))


def _item(kind: str, key: str = NULL_STR, value: str = "CAST(NULL AS VARIANT)") -> str:
    return f"named_struct('kind', {kind}, 'key', {key}, 'value', {value})"


def entry_list(doc: str, dropped=None) -> str:
    """An object of any depth as one flat list of (kind, key, value): its entries in order, depth
    first, an object's entries between the two items that begin and end it.  Each round puts
    the entries of all objects met so far in their places, so the work is one visit an entry
    and level.  ``dropped(key, value)`` leaves entries out."""
    s, i, x, e, f, g, r, m = (fresh(p) for p in "sixefgrm")

    def inside(obj: str) -> str:
        entries = f"map_entries({obj})"
        if dropped:
            entries = f"filter({entries}, {g} -> NOT ({dropped(f'{g}.key', f'{g}.value')}))"
        return f"transform({entries}, {e} -> {_item(_NEW, f'{e}.key', f'{e}.value')})"

    def look(sub: str) -> str:
        opened = f"concat(array({_item(_BEGIN, f'{x}.key')}), {inside(sub)}, array({_item(_END)}))"
        return f"CASE WHEN {sub} IS NULL THEN array({_item(_VALUE, f'{x}.key', f'{x}.value')}) ELSE {opened} END"

    def state(items: str) -> str:
        return let(items, lambda v: f"named_struct('items', {v}, 'more', exists({v}, {f} -> {f}.kind = {_NEW}))")

    grown = f"flatten(transform({s}.items, {x} -> CASE WHEN {x}.kind = {_NEW} THEN {let(as_object(f'{x}.value'), look)} ELSE array({x}) END))"
    def rounds(n: str, start: str) -> str:
        return f"aggregate(sequence(1, {n}), {start}, ({s}, {i}) -> CASE WHEN {s}.more THEN {state(grown)} ELSE {s} END)"

    # as many rounds as there are levels are needed, at most as many as there are braces; ever
    # longer runs of rounds keep those that have nothing left to do few
    braces = let(f"to_json({doc})", lambda t: f"1 + length({t}) - length(replace({t}, '{{', ''))")
    runs = f"concat(transform(sequence(1, 9), {m} -> CAST(pow(2, {m}) AS INT)), array({braces}))"
    return f"aggregate({runs}, {state(inside(doc))}, ({r}, {m}) -> CASE WHEN {r}.more THEN {rounds(m, r)} ELSE {r} END, {r} -> {r}.items)"


# Tokens of compact JSON text: a key with its colon, a brace, or a value - a text, number,
# truth value, null, or a whole array of up to ARRAYS levels; a lone ``[`` begins a deeper one.
# All quantifiers are possessive, so no text is too long.
ARRAYS = 12
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_ARRAY = ""
for _ in range(ARRAYS):
    _ARRAY = rf'\[(?:[^\[\]"]++|{_STRING}{_ARRAY and "|" + _ARRAY})*+\]'
_TOKEN = rf'{_STRING}:?+|{_ARRAY}|[{{}}\[]|[^"{{}}\[\],:]++'


def tokens(text: str, body, deeper: str) -> str:
    """``body`` of the tokens of an object's text; ``deeper`` where its arrays are too deep."""
    return let(f"regexp_extract_all({text}, {lit(_TOKEN)}, 0)", lambda t: f"CASE WHEN array_contains({t}, '[') THEN {deeper} ELSE {body(t)} END")


def _key_token(key: str) -> str:
    return f"concat(to_json(CAST({lit(key)} AS VARIANT)), ':')"


# Plain texts: a string ends at the next quote.  ``_past`` runs along keys, values and braces up to
# a key that ``but`` matches, an array that is too deep, or the end.
_ITEMS = ""
for _ in range(ARRAYS):
    _ITEMS = rf'\[(?:[^\[\]"]++|"[^"]*+"{_ITEMS and "|" + _ITEMS})*+\]'
_VALUE_TEXT = rf'"[^"]*+"|{_ITEMS}|[^"\[{{}},]++'


def _past(but: str) -> str:
    return rf'(?:[^"\[]++|(?!{but})"[^"]*+"|{_ITEMS})*+'


_DEEP = "^" + _past('(?!)') + r"\["


def plain(text: str) -> str:
    """Whether a JSON text has neither escapes nor arrays deeper than ``ARRAYS`` levels."""
    return (f"(instr({text}, {lit(chr(92))}) = 0 AND (octet_length({text}) - octet_length(replace({text}, '[', '')) <= {ARRAYS} "
            f"OR NOT regexp_like({text}, {lit(_DEEP)})))")


def _plain_keys(keys: Iterable[str]) -> list[str]:
    """Patterns of the keys that a plain text may have."""
    return [re.sub(r"([^0-9A-Za-z_])", r"\\\1", k) for k in keys if not re.search(r'[\x00-\x1f"\\]', k)]


def _clean_plain(text: str, strict: bool) -> str:
    """``clean_key`` for every key of a plain text, in which white space but blanks is escaped."""
    def each(bad: str, good: str, new: str, at: str) -> str:
        key = rf'{good}":'
        keys = rf'(?:[^"\[]++|"[^"]*+"(?!:)|{_ITEMS}|"{key})*+'
        return f"regexp_replace({at}, {lit(rf'(\G(?:^|(?!^){key}){keys}"{good}|\G(?!^){good}){bad}')}, {lit(new)})"

    good = r'[^" .\-]*+' if strict else r'(?:[^" .\-]++|-(?=[^"]*+":\{))*+'
    return let(each(r"[ .\-]", good, "$1_", text), lambda t: f"CASE WHEN instr({t}, '@') > 0 THEN {each('@', '[^"@]*+', '$1', t)} ELSE {t} END")


def _put_plain(text: str, key: str, value: str) -> str:
    """Every value of ``key`` in a plain text that is no object replaced by the JSON text ``value``."""
    for k in _plain_keys([key]):
        pattern = rf'(\G{_past(f'"{k}":[^{{]')}"{k}":)(?:{_VALUE_TEXT})'
        escaped = f"replace(replace({value}, {lit(chr(92))}, {lit(chr(92) * 2)}), '$', {lit(chr(92) + '$')})"
        text = f"regexp_replace({text}, {lit(pattern)}, concat('$1', {escaped}))"
    return text


def _drop_plain(text: str, key: str) -> str:
    """Every entry of ``key`` left out of a plain text whose value is no object."""
    for k in _plain_keys([key]):
        entry = rf'(\G{_past(f'"{k}":[^{{]')})"{k}":(?:{_VALUE_TEXT}),?+'
        last = rf'(\G(?:[^",\[]++|"[^"]*+"|{_ITEMS}|,(?!\}}))*+),(?=\}})'  # a comma before a brace that closes
        gone = f"regexp_replace(regexp_replace({text}, {lit(entry)}, '$1'), {lit(last)}, '$1')"
        text = f"CASE WHEN contains({text}, {lit(f'"{key}":')}) THEN {gone} ELSE {text} END"
    return text


def find_below(value: str, keys: Iterable[str]) -> str:
    """``find`` in a VARIANT object of any depth."""
    return let(f"to_json({value})", lambda text: find_in(text, value, keys))


def has_token(text: str, keys: Iterable[str]) -> str:
    return f"({' OR '.join(f'contains({text}, {_key_token(k)})' for k in keys)})"


def find_in(text: str, value: str, keys: Iterable[str]) -> str:
    """``find`` in the VARIANT object ``value`` whose JSON text is ``text``; texts without the keys
    aren't taken apart."""
    keys = list(keys)
    x, i, y, z = (fresh(p) for p in "xiyz")
    wanted = f"{x}.kind = {_VALUE} AND {x}.key IN ({_names(keys)}) AND CAST({x}.value AS STRING) IS NOT NULL"
    listed = f"CAST(get(filter({entry_list(as_object(value))}, {x} -> {wanted}), 0).value AS STRING)"

    def first(t: str) -> str:
        after = f"get({t}, {i} + 1)"
        hits = f"transform({t}, ({y}, {i}) -> CASE WHEN {y} IN ({', '.join(map(_key_token, keys))}) AND {after} NOT IN ('{{', 'null') THEN {after} END)"
        return f"CAST(try_parse_json(get(filter({hits}, {z} -> {z} IS NOT NULL), 0)) AS STRING)"

    def token(found: str) -> str:  # a lone ``[``: an array is too deep
        return f"CASE WHEN {found} = '[' THEN {tokens(text, first, listed)} WHEN {found} <> '' THEN CAST(try_parse_json({found}) AS STRING) END"

    names = "|".join(_plain_keys(keys)) or "(?!)"
    pattern = rf'^{_past(rf'"(?:{names})":(?!\{{|null)')}(?:"(?:{names})":)?+({_VALUE_TEXT}|\[)'
    found = f"CASE WHEN instr({text}, {lit(chr(92))}) > 0 THEN '[' ELSE regexp_extract({text}, {lit(pattern)}, 1) END"
    return f"CASE WHEN {has_token(text, keys)} THEN {let(found, token)} END"


def find(doc: str, keys: Iterable[str], depth: int) -> str:
    keys = list(keys)
    a, e = fresh("a"), fresh("e")
    sub = as_object(f"{e}.value")
    deeper = find(sub, keys, depth - 1) if depth > 1 else find_below(f"{e}.value", keys)
    hit = f"CASE WHEN {sub} IS NOT NULL THEN {deeper} WHEN {e}.key IN ({_names(keys)}) THEN CAST({e}.value AS STRING) END"
    return f"aggregate(map_entries({doc}), {NULL_STR}, ({a}, {e}) -> coalesce({a}, {hit}))"


def find_two(doc: str, one: str, two: str, depth: int) -> str:
    """STRUCT<one, two, seen>: the first value of either key, and whether a non-object entry
    of the first was met at all (with a null, if ``one`` is null), in one walk."""
    a, e = fresh("a"), fresh("e")
    sub = as_object(f"{e}.value")
    if depth > 1:
        deeper = find_two(sub, one, two, depth - 1)
    else:
        # a null entry of the first key may hide below: it is dropped as if seen
        deeper = let(f"to_json({e}.value)", lambda t: f"named_struct('one', {find_in(t, f'{e}.value', [one])}, 'two', {find_in(t, f'{e}.value', [two])}, 'seen', {has_token(t, [one])})")
    own = (f"named_struct('one', CASE WHEN {e}.key = {lit(one)} THEN CAST({e}.value AS STRING) END, "
           f"'two', CASE WHEN {e}.key = {lit(two)} THEN CAST({e}.value AS STRING) END, 'seen', {e}.key = {lit(one)})")
    here = f"CASE WHEN {sub} IS NOT NULL THEN {deeper} ELSE {own} END"
    x = fresh("x")
    merged = let(here, lambda h: f"named_struct('one', coalesce({a}.one, {h}.one), 'two', coalesce({a}.two, {h}.two), 'seen', {a}.seen OR {h}.seen)")
    zero = f"named_struct('one', {NULL_STR}, 'two', {NULL_STR}, 'seen', false)"
    return f"aggregate(map_entries({doc}), {zero}, ({a}, {e}) -> {merged}, {x} -> {x})"


def has(doc: str, keys: Iterable[str], depth: int) -> str:
    return f"coalesce({find(doc, keys, depth)} IS NOT NULL, false)"


def put(doc: str, values: Mapping[str, str]) -> str:
    """``values``: root key → SQL text of the (string) value."""
    k, v = fresh("k"), fresh("w")
    names = ", ".join(lit(n) for n in values)
    pairs = ", ".join(f"{lit(n)}, {to_variant_text(x)}" for n, x in values.items())
    kept = f"map_filter({doc}, ({k}, {v}) -> NOT {k} IN ({names}))"
    return f"CASE WHEN {doc} IS NOT NULL THEN map_concat({kept}, map({pairs})) END"


# Fixed values of the key clean-up: Java's white space class plus ``.`` become ``_``,
# ``@`` is removed, ``-`` becomes ``_`` for keys of non-object values.
_SPACE_AND_DOT = " \\t\\n\\u000B\\u000C\\r."  # as SQL escapes
_SPACE_AND_DOT_LEN = 7


def clean_key(key: str, scalar: bool, strict: bool = False) -> str:
    dash = "-" if scalar or strict else ""
    n = _SPACE_AND_DOT_LEN + len(dash)
    return f"translate({key}, '{_SPACE_AND_DOT}{dash}@', '{'_' * n}')"


def rebuild_below(value: str, on_object, on_value, dropped, changed=None) -> str:
    """``rebuild`` of a VARIANT object of any depth, as VARIANT: each token of its text becomes its
    piece of JSON text; clashing keys meet again when the whole is parsed.  ``changed`` does the
    same to a plain text."""
    x, i = fresh("x"), fresh("i")
    quoted = lambda k: f"to_json(CAST({k} AS VARIANT))"

    def written(t: str) -> str:
        """An entry: a key without escapes stands in the text as it is, clean-up adds none."""
        after, plain = f"get({t}, {i} + 1)", f"instr({x}, '\\\\') = 0"
        name = lambda k: f"CASE WHEN {plain} THEN concat('\"', {k}, '\"') ELSE {quoted(k)} END"

        def entry(k: str) -> str:
            new_key, new_value = on_value(k, after, True)
            return (f"CASE WHEN {after} = '{{' THEN concat({name(on_object(k))}, ':') "
                    f"ELSE concat({name(new_key)}, ':', coalesce({new_value}, 'null')) END")

        comma = f"CASE WHEN get({t}, {i} - 1) = '{{' THEN '' ELSE ',' END"
        return (f"CASE WHEN {x} IN ('{{', '}}') THEN {x} WHEN endswith({x}, ':') THEN concat({comma}, {let(_token_key(x), entry)}) ELSE '' END")

    def text(t: str) -> str:
        return f"try_parse_json(array_join(transform({t}, ({x}, {i}) -> {written(t)}), ''))"

    def whole(t: str) -> str:
        if not dropped:
            return text(t)
        y, j = fresh("y"), fresh("j")
        gone = lambda key, after: f"coalesce(endswith({key}, ':') AND {after} <> '{{' AND {dropped(_token_key(key))}, false)"
        return let(f"filter({t}, ({y}, {j}) -> NOT ({gone(y, f'get({t}, {j} + 1)')} OR {gone(f'get({t}, {j} - 1)', y)}))", text)

    def anew(v: str) -> str:
        each = tokens(v, whole, rebuild_listed(as_object(value), on_object, on_value, dropped))
        if changed is None:
            return each
        parsed = let(changed(v), lambda t: f"CASE WHEN {t} = {v} THEN {value} ELSE try_parse_json({t}) END")
        return f"CASE WHEN {plain(v)} THEN {parsed} ELSE {each} END"

    return let(f"to_json({value})", anew)


def _token_key(token: str) -> str:
    """The key of a key's token."""
    return (f"CASE WHEN instr({token}, '\\\\') = 0 THEN substring({token}, 2, length({token}) - 3) "
            f"ELSE CAST(try_parse_json(left({token}, length({token}) - 1)) AS STRING) END")


def rebuild_listed(doc: str, on_object, on_value, dropped) -> str:
    """``rebuild_below`` by the entry list."""
    x, i = fresh("x"), fresh("i")
    new_key, new_value = on_value(f"{x}.key", f"to_json({x}.value)", True)
    name = lambda k: f"to_json(CAST({k} AS VARIANT))"
    gone = dropped and (lambda k, v: f"{dropped(k)} AND {as_object(v)} IS NULL")

    def text(items: str) -> str:
        comma = f"CASE WHEN {i} = 0 OR get({items}, {i} - 1).kind = {_BEGIN} THEN '' ELSE ',' END"
        piece = (f"CASE {x}.kind WHEN {_END} THEN '}}' WHEN {_BEGIN} THEN concat({comma}, {name(on_object(f'{x}.key'))}, ':{{') "
                 f"ELSE concat({comma}, {name(new_key)}, ':', coalesce({new_value}, 'null')) END")
        return f"try_parse_json(concat('{{', array_join(transform({items}, ({x}, {i}) -> {piece}), ''), '}}'))"

    return let(entry_list(doc, gone), text)


def rebuild(doc: str, depth: int, on_object, on_value, dropped=None, changed=None) -> str:
    """Every entry anew: ``on_object(key)`` names an object's entry, ``on_value(key, value, text)``
    gives (key, value) of any other, ``text`` if the value is JSON text; ``dropped(key)`` leaves
    entries that are no objects out; ``changed(text)`` does all this to a plain JSON text."""
    e, f = fresh("e"), fresh("f")
    new_key, new_value = on_value(f"{e}.key", f"{e}.value", False)

    sub = as_object(f"{e}.value")
    if depth > 1:
        obj_value = f"to_variant_object({rebuild(sub, depth - 1, on_object, on_value, dropped, changed)})"
    else:
        obj_value = rebuild_below(f"{e}.value", on_object, on_value, dropped, changed)
    as_obj = f"named_struct('k', {on_object(f'{e}.key')}, 'v', {obj_value})"
    as_val = f"named_struct('k', {new_key}, 'v', {new_value})"
    entries = f"map_entries({doc})"
    if dropped:
        entries = f"filter({entries}, {f} -> NOT ({dropped(f'{f}.key')} AND {as_object(f'{f}.value')} IS NULL))"
    return f"map_from_entries(transform({entries}, {e} -> CASE WHEN {sub} IS NOT NULL THEN {as_obj} ELSE {as_val} END))"


def rewrite(doc: str, depth: int, clean_keys: bool = True, strict: bool = False,
            replace: Mapping[str, str] | None = None) -> str:
    """``replace``: key → SQL text of the new (string) value."""
    values = {k: to_variant_text(v) for k, v in (replace or {}).items()}

    def on_object(k: str) -> str:
        return clean_key(k, scalar=False, strict=strict) if clean_keys else k

    def on_value(k: str, old: str, text: bool):
        key = clean_key(k, scalar=True, strict=strict) if clean_keys else k
        value = old
        for name, v in values.items():
            value = f"CASE WHEN {key} = {lit(name)} THEN {f'to_json({v})' if text else v} ELSE {value} END"
        return key, value

    def changed(text: str) -> str:
        out = _clean_plain(text, strict) if clean_keys else text
        for name, v in values.items():
            out = _put_plain(out, name, f"coalesce(to_json({v}), 'null')")
        return out

    return rebuild(doc, depth, on_object, on_value, changed=changed)


def drop_scalar_key(doc: str, key: str, depth: int) -> str:
    """Every non-object entry named ``key`` left out, at every depth."""
    return rebuild(doc, depth, lambda k: k, lambda k, v, text: (k, v), lambda k: f"{k} = {lit(key)}", lambda text: _drop_plain(text, key))


def copy(doc: str, source: str, target: str, depth: int) -> str:
    def filled(f: str) -> str:
        value = {target: f"{f}.two"}
        without = let(drop_scalar_key(doc, target, depth), lambda c: put(c, value))
        return f"CASE WHEN {f}.one IS NOT NULL THEN {doc} WHEN {f}.seen THEN {without} ELSE {put(doc, value)} END"

    if source == target:  # dropped first, so never found
        none = let(drop_scalar_key(doc, target, depth), lambda c: put(c, {target: NULL_STR}))
        return f"CASE WHEN {has(doc, [target], depth)} THEN {doc} ELSE {none} END"
    return let(find_two(doc, target, source, depth), filled)
