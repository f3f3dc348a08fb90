"""Turn repair against a plain search over all edits, conversation by conversation."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from shoal.llm import queries, turns

SF = "/root/testdata/sf0.001"
GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def hurt(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        yield from [(conv, turn, role, text)] * (2 if draw == 3 else 1)


def faults(rows):
    seen = set()
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if BLANK.fullmatch(text) else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None
        seen.add((role, text))
        yield fault


def cheapest(roles, wrong):
    """(cost, audit, roles of what stays or is new): the least over all edit sequences, where
    the text so far matters only by the last of its initials."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, end):
        options = [(0, "", ())] if i == len(roles) and end in ("", "a") else []
        if i < len(roles):
            c, audit, out = best(i + 1, end)
            options.append((c + 4, "D" + audit, (None, *out)))
            for new in "ua" if wrong[i] not in ("blank", "duplicate") else "":
                if new in follows[end]:
                    c, audit, out = best(i + 1, new)
                    options.append((c + 3 + 3 * (wrong[i] == "truncated"), "R" + audit, ({"u": "user", "a": "assistant"}[new], *out)))
            if wrong[i] not in ("blank", "duplicate") and roles[i] and roles[i][0] in follows[end]:
                c, audit, out = best(i + 1, roles[i][0])
                options.append((c + 3 * (wrong[i] == "truncated"), "K" + audit, (roles[i], *out)))
        for n in (1, 2):  # a third insert in a row is never cheapest
            path, at = "", end
            for _ in range(n):
                at = follows[at][-1]
                path += at
            c, audit, out = after(i, at)
            options.append((c + 3 * n, "I" * n + audit, (*({"u": "user", "a": "assistant"}[p] for p in path), *out)))
        return min(options)

    @cache
    def after(i, end):
        """As ``best``, but no insert comes first."""
        options = [(0, "", ())] if i == len(roles) and end in ("", "a") else [(10 ** 9, "~", ())]
        if i < len(roles):
            c, audit, out = best(i + 1, end)
            options.append((c + 4, "D" + audit, (None, *out)))
            free = wrong[i] not in ("blank", "duplicate")
            for new in "ua" if free else "":
                if new in follows[end]:
                    c, audit, out = best(i + 1, new)
                    options.append((c + 3 + 3 * (wrong[i] == "truncated"), "R" + audit, ({"u": "user", "a": "assistant"}[new], *out)))
            if free and roles[i] and roles[i][0] in follows[end]:
                c, audit, out = best(i + 1, roles[i][0])
                options.append((c + 3 * (wrong[i] == "truncated"), "K" + audit, (roles[i], *out)))
        return min(options)

    return best(0, "")


def all_sequences(roles, wrong):
    """The same by listing every sequence (short conversations only)."""
    best = None
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    edits = [["D"] + ([] if w in ("blank", "duplicate") else ["Ru", "Ra", "K"]) for w in wrong]
    for e in itertools.product(*edits):
        for ins in itertools.product(inserts, repeat=len(roles) + 1):
            initials, audit, cost = "", "", 0
            for k in range(len(roles) + 1):
                initials += "".join(ins[k])
                audit += "I" * len(ins[k])
                cost += 3 * len(ins[k])
                if k < len(roles):
                    audit += e[k][0]
                    cost += {"D": 4, "R": 3, "K": 0}[e[k][0]] + 3 * (e[k] != "D" and wrong[k] == "truncated")
                    initials += "" if e[k] == "D" else e[k][1] if e[k][0] == "R" else (roles[k] or "?")[0]
            if GRAMMAR.fullmatch(initials) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r, x) for c, t, r, x in hurt([r for r in rows if r[0] == conv])), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        wrong = list(faults(own))
        cost, audit, stays = cheapest([r for _, r, _ in own], wrong)
        kept, k, said = iter(stays), 0, []
        for edit in audit:
            role, text = next(kept), ""
            if edit != "I":
                text = own[k][2]
                k += 1
            if edit != "D":
                said.append(f"{role}:{text}")
        known = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(wrong.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_against_plain_search(spark):
    rows = [tuple(r) for r in queries.load(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op11_turn_repair"](spark, SF)) == plain(rows)


def odd_rows(n, seed):
    r = random.Random(seed)
    texts = ["yes.", "no", "ok!", "", " \t", None, "what? ", "a.b", "Größe 文.\n"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "umpire"]
    return [(r.choice([None, *range(n // 8)]), r.choice([None, *range(12)]), r.choice(roles), r.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_cases_in_chunks_of_every_size(spark, bits):
    """Nulls, ties, repeated rows, odd roles, one conversation of a third of the rows, one that
    loses all; extra columns with the operator's own names."""
    rows = odd_rows(240, 3) + [(10_000, t, "assistant" if t % 3 else "user", "" if 30 < t < 60 else f"t{t}.") for t in range(120)]
    lost = next(c for c in range(20_000, 21_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone."))
    df = spark.createDataFrame([(*x, 1, "z", "K") for x in rows], "conv_id long, turn long, role string, text string, pos int, code string, edit string")
    want = plain(rows)
    assert want[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(turns.digests(df, bits)) == want


def test_least_audit_over_all_sequences():
    r = random.Random(5)
    back, forward = turns.Backward(), turns.Forward()
    flags = {None: 0, "blank": turns.BLANK, "duplicate": turns.DUPLICATE, "truncated": turns.TRUNCATED}
    for _ in range(150):
        n = r.randrange(0, 3)
        roles = [r.choice(["user", "assistant", "system", "tool", ""]) for _ in range(n)]
        wrong = [r.choice([None, None, *flags]) for _ in range(n)]
        codes = bytes((turns.INITIALS.find(x[:1]) if x[:1] and x[:1] in turns.INITIALS else 3) + flags[w] for x, w in zip(roles, wrong))
        done = list(forward.trace(codes, back.run(codes, turns.SPECULATED), turns.START, True))
        mine = sum(c for _, _, c, _ in done), "".join(e for _, e, _, _ in done)
        assert mine == all_sequences(roles, wrong) == cheapest(roles, wrong)[:2]


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    back = turns.Backward()
    codes = bytes([1, 2] * 50)
    old = back.run(codes, turns.SPECULATED)
    new = back.run(codes, b"\x06\x03\x00\x03", old)
    assert new == back.run(codes, b"\x06\x03\x00\x03") and new[:4 * 90] == old[:4 * 90] and new != old


def test_empty_table_and_edits(spark):
    schema = "conv_id string, turn int, role string, text string"
    none = spark.createDataFrame([], schema)
    assert turns.digests(none).count() == 0 and turns.repair(none).count() == 0
    rows = spark.createDataFrame([("x", 0, "assistant", "Hi."), ("x", 1, "user", "cut"), ("x", 1, "user", "cut")], schema)
    edited = [tuple(r)[3:] for r in turns.repair(rows).orderBy("pos", "step").collect()]
    assert edited == [("I", 3, None, None, None, "user", ""), ("K", 0, None, 0, "assistant", "assistant", "Hi."),
                      ("D", 4, "truncated", 1, "user", None, "cut"), ("D", 4, "duplicate", 1, "user", None, "cut")]
