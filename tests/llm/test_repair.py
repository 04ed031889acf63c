import hashlib
import itertools
import random
import re
import zlib

from gleanrow.llm import registry, repair

WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """{conv_id: [(turn, role, text)]} after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
    return out


def plain_faults(own):
    seen, out = set(), []
    for _, role, text in own:
        shown = text.strip(WHITE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(own, faults):
    """(cost, audit, rows) of all edits with at most two inserts in a row, by trying them all."""
    best = None
    gaps = [x for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    choices = [("D",) if f in ("blank", "duplicate") else ("D", "K", "user", "assistant") for f in faults]
    for edits in itertools.product(*choices):
        kept = 0
        for f, e in zip(faults, edits, strict=True):
            kept += 3 if e == "D" else (0 if e == "K" else 2) + (f == "truncated")
        if best and kept > best[0]:
            continue
        for added in itertools.product(gaps, repeat=len(own) + 1):
            cost = kept + 2 * sum(map(len, added))
            if best and cost > best[0]:
                continue
            audit, rows = "", []
            for i, put in enumerate(added):
                audit += "I" * len(put)
                rows += [(r, "") for r in put]
                if i < len(own):
                    e = edits[i]
                    audit += e if e in "DK" else "R"
                    if e != "D":
                        rows.append((own[i][1] if e == "K" else e, own[i][2]))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in rows)) and all(r for r, _ in rows):
                found = (cost, audit, rows)
                best = found if best is None or found[:2] < best[:2] else best
    return best


def plain_report(own):
    faults = plain_faults(own)
    cost, audit, rows = every_repair(own, faults)
    turns = [t for t, _, _ in own if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


SCHEMA = "conv_id long, turn long, role string, text string, copies string, place string"


def told(rows):
    return {r["conv_id"]: tuple(r)[1:] for r in rows.collect()}


def test_against_all_edits(spark):
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", None], ["Yes.", "No", "Why?", " \n", "", None, "Ok! "]
    rows = [(c, rng.choice([None, t, t, t + 1, t * 2]), rng.choice(roles), rng.choice(texts)) for c in range(150) for t in range(rng.randrange(1, 5))]
    rows += [(None, 1, "user", "Hi."), (None, 0, "", "Well."), (500, None, "user", "a."), (500, None, "assistant", "b."), (900, 3, "user", "x" * 100_000 + ".")]
    want = {c: plain_report(own) for c, own in plain_damage(rows).items()}
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    assert told(repair.report(repair.damage(frame))) == want
    assert told(repair.report(repair.damage(frame), held=1)) == want  # texts wait in files
    assert all(any(label in w[6] for w in want.values()) for label in "KRDI")


def test_rows_of_the_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Hello."), (2, 0, "assistant", "Well."),
        (3, 0, "user", " ")]
    found = repair.repair(repair.whole(spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA))).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in found] == [(1, 0, "K", "system", "Be kind."), (1, 1, "K", "user", "Hi."), (1, 2, "R", "assistant", "Hello."),
        (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "Well.")]


def test_empty_and_gone(spark, tmp_path):
    assert repair.report(repair.damage(spark.createDataFrame([], SCHEMA))).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    nothing = hashlib.sha256(b"").hexdigest()
    assert told(registry.op13_conversation_repair(spark, str(tmp_path))) == {gone: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_long_conversation():
    """Costs and edits of a conversation of 200,000 rows: it is cut in pieces that repair alike."""
    machine = repair.Composition()
    kinds = [("u", repair.SOUND), ("u", repair.CUT), ("a", repair.DUPLICATE), ("a", repair.SOUND)] * 50_000
    cost, arcs = machine.repair(kinds)
    labels = "".join(label for some in arcs for label, _ in some)
    assert len(machine.made) < 200
    one, few = machine.repair(kinds[:4])
    assert cost == 50_000 * one and labels == "".join(label for some in few for label, _ in some) * 50_000
