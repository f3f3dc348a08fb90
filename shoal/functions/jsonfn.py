"""JSON document functions as native Column expressions.

A document is parsed once into ``MAP<STRING, VARIANT>`` (the JSON object's root) and
every operator below works on that map's column, given by name.  Nested objects are
reached by casting a ``VARIANT`` value to ``MAP<STRING, VARIANT>``; the walkers are
higher-order functions (``transform`` / ``aggregate`` / ``map_from_entries``), built as SQL
text by :mod:`shoal.functions.jsonsql`, so Catalyst sees ordinary expressions and no
Python runs per row.

Semantics, shared by all walkers:
  * arrays are opaque: a walker never descends into a list, a list is a value;
  * an object value is descended into, never matched as a value, at any depth;
  * entries are visited in the ``VARIANT`` order (keys sorted), depth first.

``depth`` is how many levels are unrolled for speed; deeper objects are walked too.
Set the session with :func:`shoal.session.configure` (duplicate keys, last wins).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoal.functions import jsonsql as Q

DOC_TYPE = "map<string,variant>"
DEFAULT_DEPTH = 4  # unrolled levels
REBUILD_DEPTH = 1  # of a document written anew: every level above makes all objects below it again


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_doc(text: str) -> Column:
    """JSON text column → ``MAP<STRING,VARIANT>``; malformed text or a non-object root → null."""
    return F.expr(Q.parse_doc(Q.ident(text)))


def bind_once(df, columns):
    """Add ``columns`` (name → Column) as plain attributes computed exactly once per row.

    They leave through ``inline`` of a one-element array, i.e. a ``Generate`` node.
    A filter on a derived column is otherwise pushed below its projection by Catalyst,
    which copies the expression (a JSON parse, say) into every predicate; a filter on
    a generated column cannot be pushed below the generator, so the work is done once."""
    row = columns if isinstance(columns, Column) else F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def doc_to_json(doc: Column | str) -> Column:
    """Serialise a document back to JSON text (one pass, at the end)."""
    return F.to_json(_col(doc))


def doc_keys(doc: Column | str) -> Column:
    """Root keys, sorted and comma-joined (used by checks and tests)."""
    return F.array_join(F.array_sort(F.map_keys(_col(doc))), ",")


def json_find(doc: str, key: str | Iterable[str], depth: int = DEFAULT_DEPTH) -> Column:
    """Value (as text) of the first non-object entry named ``key`` at any depth.

    ``key`` may be several names: the first entry carrying any of them wins.  A JSON
    null is no match and the search goes on.  Arrays are returned whole as JSON text.
    """
    return F.expr(Q.find(Q.ident(doc), [key] if isinstance(key, str) else list(key), depth))


def json_has(doc: str, key: str | Iterable[str], depth: int = DEFAULT_DEPTH) -> Column:
    """the key (or any of the keys) carries a non-null value somewhere."""
    return F.expr(Q.has(Q.ident(doc), [key] if isinstance(key, str) else list(key), depth))


def json_put(doc: str, values: Mapping[str, str | None] | None = None, columns: Mapping[str, str] | None = None) -> Column:
    """Add or overwrite root keys with texts (``values``) or with columns' values
    (``columns``: key → column name), stored as JSON strings (or null)."""
    texts = {k: (Q.NULL_STR if v is None else Q.lit(v)) for k, v in (values or {}).items()}
    texts |= {k: Q.ident(c) for k, c in (columns or {}).items()}
    return F.expr(Q.put(Q.ident(doc), texts))


def json_rewrite(doc: str, depth: int = REBUILD_DEPTH, clean_keys: bool = True, strict: bool = False,
                 replace: Mapping[str, str] | None = None) -> Column:
    """J4 + J5 in one pass over the document: clean every key (``clean_keys``) and give
    every non-object entry whose (cleaned) key is in ``replace`` the new value.  Two
    keys that become equal keep the later entry (``mapKeyDedupPolicy=LAST_WIN``).

    Key clean-up: drop ``@``; white space and ``.`` → ``_``; ``-`` → ``_`` only for keys of
    non-object values unless ``strict``.  One ``translate`` (no regex)."""
    texts = {k: Q.lit(v) for k, v in (replace or {}).items()}
    return F.expr(Q.rewrite(Q.ident(doc), depth, clean_keys, strict, texts))


def json_replace(doc: str, key: str, value: str, depth: int = REBUILD_DEPTH) -> Column:
    """Every non-object entry named ``key`` (any depth) gets ``value``; nothing is added."""
    return json_rewrite(doc, depth, clean_keys=False, replace={key: value})


def json_sanitize_keys(doc: str, depth: int = REBUILD_DEPTH, strict: bool = False) -> Column:
    """Make every key at every depth a legal column name (see :func:`json_rewrite`)."""
    return json_rewrite(doc, depth, clean_keys=True, strict=strict)


def json_copy(doc: str, source: str, target: str, depth: int = REBUILD_DEPTH) -> Column:
    """If ``target`` already has a value anywhere the document is unchanged;
    otherwise every scalar ``target`` is removed and ``target`` is set at the root to
    the value of ``source`` (found at any depth; null when absent).  One walk finds both;
    the document is rebuilt only if it has a null ``target`` to remove."""
    return F.expr(Q.copy(Q.ident(doc), source, target, depth))
