import hashlib
import random
import re
import zlib

from ledgerflow.llm import queries, turnrepair as T

from ..conftest import SF_SMALL

COLS = "conv_id long, turn long, role string, text string"


def brute_audit(symbols: str) -> tuple[int, str]:
    """Cheapest, then ASCII-least, by trying every edit at every row."""
    roles = {"": "su", "s": "u", "u": "a", "a": "u"}  # the last initial so far -> what may follow

    best: dict = {}
    for i in range(len(symbols), -1, -1):
        for inserted in (3, 2, 1, 0):
            for last in roles:
                found = [(0, "")] if i == len(symbols) and last in ("", "a") else []
                follow = "a" if last == "u" else "u"
                ways = [("I", 3, (i, follow, inserted + 1))] if inserted < 3 else []
                if i < len(symbols):
                    x = symbols[i]
                    more = 3 if x.isupper() else 0
                    ways.append(("D", 4, (i + 1, last, 0)))
                    if x != "-":
                        ways.append(("R", 3 + more, (i + 1, follow, 0)))
                        if x.lower() in roles[last]:
                            ways.append(("K", more, (i + 1, x.lower(), 0)))
                found += [(cost + best[to][0], e + best[to][1]) for e, cost, to in ways if to in best]
                best[i, last, inserted] = min(found, default=(10 ** 9, "~"))
        for old in [k for k in best if k[0] > i + 1]:
            del best[old]
    return best[0, "", 0]


def brute_report(rows: list[tuple]) -> dict:
    """The whole contract, one conversation after another, in plain Python."""
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if deal == 0:
                continue
            text = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
            mine += [(c, turn, "user" if deal == 4 else role, text)] * (2 if deal == 3 else 1)
        mine.sort(key=order)
        seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1][-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in "sua" and role else "x"
            symbols += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, audit = brute_audit(symbols)
        lines, last, rest = [], "", list(mine)
        for e in audit:
            row = rest.pop(0) if e != "I" else None
            follow = "a" if last == "u" else "u"
            if e == "K":
                lines.append(f"{row[2]}:{row[3]}")
                last = row[2][0]
            elif e in "IR":
                lines.append({"u": "user", "a": "assistant"}[follow] + ":" + (row[3] if row else ""))
                last = follow
        turns = [r[1] for r in mine if r[1] is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(),
                     sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_dict(df) -> dict:
    got = df.collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in got}


def test_runs_give_brute_force_audits():
    rng = random.Random(3)
    for n in [0, 1, 2, 3, 5, 8, 13, 40] * 25:
        symbols = "".join(rng.choice(T.SYMBOLS) * rng.choice([1, 1, 2, 7]) for _ in range(n))
        assert T.repair_one(symbols) == brute_audit(symbols), symbols


def test_powers_equal_single_steps():
    for s in T.SYMBOLS:
        v = T.before_end(T.END, True)
        for n in range(1, 70):
            v = T.product(T.power(s, 0), v)
            assert (T.run_advance(s, n, T.before_end(T.END, True)) == v).all()


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    texts = ["Yes.", "No", "", None, " \t", "What?", "Ends. ", "東京!", "a "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]), rng.choice(texts + [f"text {c} {t}."] * 9))
            for c in range(40) for t in range(rng.randrange(1, 15))]
    rows += [(None, 3, "user", "no id."), (None, None, "assistant", "no turn."), (7, None, "user", "no turn"), (8, 2, "user", "again."), (8, 2, "user", "again.")]
    rows += [(99, t, "user" if t % 3 else "assistant", f"turn {t}.") for t in range(700)] + [(100, t, "user", "same.") for t in range(300)]
    return rows


def test_report_equals_brute_force_with_hot_conversation_and_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, COLS)
    for c in ("num", "conv", "state", "ops", "fault", "part", "cost"):
        df = df.withColumn(c, df["role"])
    expected = brute_report(rows)
    # Segments of 8 rows: one conversation runs over some ninety of them.
    assert as_dict(T.report(df, segment=8)) == expected
    assert as_dict(T.report(df.repartition(7))) == expected


def test_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "end."), (1, 1, "assistant", "ok.")]
    assert as_dict(T.report(spark.createDataFrame(rows, COLS))) == brute_report(rows)
    assert T.report(spark.createDataFrame([], COLS)).collect() == []


def test_all_rows_dropped(spark):
    n = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = as_dict(T.report(spark.createDataFrame([(n, 0, "user", "gone.")], COLS)))
    assert got == {n: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.QUERIES["op12_turnrepair"](spark, SF_SMALL)) == brute_report(rows)
