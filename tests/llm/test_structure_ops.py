"""License scans, conversation repair and the Merkle manifest against brute-force versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm_data import DOC_SCHEMA, frame, odd_texts, prose
from parcelscope.llm import licenses, merkle, repair


# ---------------------------------------------------------------- 11 licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), sorted((at, label) for label, phrase in licenses.BASE.items() for at in range(len(words))
                              if words[at:at + len(phrase.split())] == phrase.split())


def license_texts():
    mit = licenses.TEMPLATES[0][1]
    edited = mit.replace("any person", "each person").replace("(the Software)", "").replace("copy of", "copy or two of")
    both = "Released UNDER THE MIT LICENSE.\n" + prose(3, 50) + " under-the-mit-license, Apache License, Version 2.0; cc by nc"
    return [(20, mit), (21, prose(1, 40) + " " + mit + " " + prose(2, 40)), (22, edited), (23, both),
            (24, "under the\x00mit\x7flicense cc_by nc by nc cc by nc by nc"), (25, "under the mİt license"),
            (26, "worKs under the mit licenseé"), (27, "the mit license"), (28, "cc by nc " * 4000),
            (29, "license " * 20_000 + "mit " * 20_000), (30, "permission granted " * 3000), (31, "...!?"),
            (32, "This work is licensed under the GNU General Public License, version 3.")]


def test_license_scan(spark):
    texts = odd_texts() + license_texts()
    got = {}
    for r in licenses.scan_licenses(frame(spark, texts)).collect():
        assert got.setdefault(r.doc_id, r) == r  # repeated rows agree
    for i, t in texts:
        n, places = base_places(t)
        at = [p for p, _ in places]
        assert (got[i].n_words, got[i].n_base) == (n, len(places)), i
        assert (got[i].first_word, got[i].last_word) == ((min(at), max(at)) if at else (None, None))
        base = sorted({label for _, label in places})
        assert got[i].base_labels == ",".join(base)
        assert set(base) <= set(filter(None, got[i].labels.split(",")))
        assert 0 <= got[i].score <= 1 and (got[i].score > 0) == bool(got[i].labels)
        if places:
            assert got[i].score == 1
    assert [got[i].labels for i in (20, 21, 23, 32)] == ["mit", "mit", "apache-2,cc-by-nc,mit", "gpl-3"]
    assert got[20].score == got[21].score == 1
    assert got[22].labels == "mit" and 0.3 < got[22].score < 1  # an edited copy
    assert not any(got[i].labels for i in (25, 26, 29, 30, 31, None))
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_license_counts_use_all_documents(spark):
    texts = license_texts()
    df = licenses.document_frequency(licenses.with_words(frame(spark, texts).select("doc_id", "text")))
    want = {w: sum(w in re.findall(f"[^{licenses.SEPARATORS}]+", t.translate(LOWER)) for _, t in texts)
            for w in licenses.VOCABULARY}
    assert df == want


# ---------------------------------------------------------------- 12 conversation repair

def cheapest(codes, start=0, goals=repair.DONE):
    """The same by a table over rows and states."""
    def inserted(by):
        for _ in range(8):
            for s, (cost, audit) in list(by.items()):
                t = repair.AFTER[s, repair.WANTED[s]]
                by[t] = min(by.get(t, (9e9, "")), (cost + 2, audit + "I"))
        return by
    by = inserted({start: (0, "")})
    for code in codes:
        new = {}
        for s, (cost, audit) in by.items():
            for e, t, w in repair.row_edits(code, s):
                new[t] = min(new.get(t, (9e9, "")), (cost + w, audit + e))
        by = inserted(new)
    return min((by[g] for g in goals if g in by), default=None)


def test_bidirectional_search_agrees_with_table():
    r = random.Random(5)
    for k in range(1500):
        codes = "".join(r.choice(repair.CODES if k % 2 else "uasUAx") for _ in range(r.randint(0, 22)))
        start, goals = r.choice([0, 0, 1, 2, 3]), r.choice([repair.DONE, (0,), (1,), (2,), (3,)])
        assert repair.cheapest_edits(codes, start, goals) == cheapest(codes, start, goals), (codes, start, goals)
        if k % 5 == 0:
            n = r.randint(1, 9)
            blocks = [codes[i:i + n] for i in range(0, len(codes), n)] or [""]
            (whole,) = repair.combined([repair.block_table(b, i == 0, i == len(blocks) - 1) for i, b in enumerate(blocks)])
            assert whole[2:] == cheapest(codes), (codes, n)


def test_audits_by_hand():
    assert repair.cheapest_edits("") == (0, "")
    assert repair.cheapest_edits("sua") == (0, "KKK")
    assert repair.cheapest_edits("u") == (2, "KI")
    assert repair.cheapest_edits("s") == (3, "D")
    assert repair.cheapest_edits("uu") == (2, "KR")
    assert repair.cheapest_edits("xUa") == (4, "DKK")


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, text) of one conversation."""
    rows = sorted(((t is not None, t or 0, r, x) for t, r, x in rows))
    seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        kept = text.strip("\x20\t\n\x0b\f\r")
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
        seen.add((role, text))
        i = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else i.upper() if fault else i
        if fault:
            faults[fault] += 1
    ini = [role[:1] for _, _, role, _ in rows]
    turns = [t for known, t, _, _ in rows if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = cheapest(codes)
    out, state, left = [], 0, list(rows)
    for e in audit:
        if e == "D":
            left.pop(0)
            continue
        want = repair.WANTED[state]
        if e == "I":
            out.append(f"{repair.NAMES[want]}:")
        else:
            _, _, role, text = left.pop(0)
            out.append(f"{role if e == 'K' else repair.NAMES[want]}:{text}")
            want = role[0] if e == "K" else want
        state = repair.AFTER[state, want]
    return (gaps, *faults.values(), sum(a + b not in repair.LEGAL for a, b in zip(ini, ini[1:])), cost, audit, "\n".join(out))


SCHEMA = "conv_id long, turn long, role string, text string, audit string, pos long, block long"


def conversations():
    r = random.Random(9)
    rows = []
    for conv in [None, *range(1, 25)]:
        for turn in range(r.randint(1, 60 if conv in (None, 3) else 9)):
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None]),
                         r.choice(["Yes.", "No", "Who?  \n", "", " \t", None, "Ünï!", f"t{turn}.", "long " * 300])))
    rows += [(40, 0, "user", "Hi."), (40, 0, "user", "Hi."), (41, None, None, None)]
    rows.append((50, next(t for t in range(999) if zlib.crc32(f"50:{t}".encode()) % 20 == 0), "user", "gone."))
    return rows


def test_repair_agrees_with_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame([(*x, "clash", 5, 6) for x in rows], SCHEMA)
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for block in (repair.BLOCK, 4):
        got = {r.conv_id: r for r in repair.repair_conversations(repair.damaged(df), df, block).collect()}
        assert set(got) == set(by)
        for conv, left in by.items():
            want = repaired(left) if left else (0, 0, 0, 0, 0, 0, "", "")
            assert tuple(got[conv])[1:-1] == want[:-1], conv
            assert got[conv].repaired_sha256 == hashlib.sha256(want[-1].encode()).hexdigest()
    assert got[50].audit == "" and got[50].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    turns = {}
    for r in sorted(repair.repaired_turns(repair.damaged(df), 4).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: "\n".join(t) for c, t in turns.items()} == {c: repaired(x)[-1] for c, x in by.items() if x and repaired(x)[-1]}
    assert repair.repair_conversations(df.limit(0)).count() == 0


def test_repair_combines_blocks_over_several_levels(spark):
    r = random.Random(2)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), f"text {t}" + r.choice([".", ""])) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (got,) = repair.repair_conversations(df, block=2).collect()  # 150 blocks, 3, 1
    want = repaired([x[1:] for x in rows])
    assert tuple(got)[1:-1] == want[:-1] and got.repaired_sha256 == hashlib.sha256(want[-1].encode()).hexdigest()


# ---------------------------------------------------------------- 13 Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(hashes, arity):
    """Root, and the proof of every leaf as (left, right) by level."""
    proofs, level, own = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        for leaf, at in enumerate(own):
            run = at - at % arity
            proofs[leaf].append(("".join(level[run:at]), "".join(level[at + 1:run + arity])))
        level = [sha(*level[k:k + arity]) for k in range(0, len(level), arity)]
        own = [at // arity for at in own]
    return level[0], proofs


def manifest_rows(docs, arity):
    def leaf(i, s, lang, n, t):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)])
    by = {}
    for d in docs:
        by.setdefault(d[1], []).append((d[0] is not None, d[0] or 0, leaf(*d), d))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(by[s], key=lambda x: x[:3]) for s in keys}
    subs = {s: tree([x[2] for x in g], arity) for s, g in groups.items()}
    root, above = tree([subs[s][0] for s in keys], arity)
    out = []
    for s, up in zip(keys, above):
        for (_, _, h, d), proof in zip(groups[s], subs[s][1]):
            path = proof + up
            even = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0
            node = leaf(*d[:4], d[4].replace("\n", "")) if even and d[4] is not None else h
            for left, right in path:
                node = sha(left, node, right)
            out.append((d[0], h, subs[s][0], root, sha(*[x for p in path for x in p]), node, node == root))
    return out


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_agrees_with_brute_force(spark, arity):
    r = random.Random(arity)
    docs = [(i, r.choice(["a", "b", "é", "", None, "a"]), r.choice(["en", None]), r.choice([None, 5, -1]),
             r.choice([None, "", "one\ntwo", "漢\n", prose(i, 5)])) for i in range(57)]
    docs += [(3, "lone source", "en", 1, "x\ny"), (None, "a", None, None, None), (None, "a", "en", 2, "no id\n")]
    docs += [docs[5], docs[5], (5, "a", "en", 1, "other row of the id")]
    df = spark.createDataFrame([(i, t, lang, s, n, 1, 2, 3, 4, .5, "x") for i, s, lang, n, t in docs], DOC_SCHEMA)
    got = merkle.verified_manifest(df.withColumns({"leaf": F.lit("clash"), "idx": F.lit(1), "g": F.lit("g")}), arity)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(manifest_rows(docs, arity), key=key)


def test_manifest_of_few_rows(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert merkle.verified_manifest(empty).count() == 0
    (one,) = merkle.verified_manifest(frame(spark, [(1, "text")])).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("")
    with pytest.raises(ValueError):
        merkle.manifest(empty, 1)


def test_long_texts(spark):
    df = frame(spark, [(1, "word " * 2_000_000 + "under the mit license"), (2, "short")])
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert (got[1].n_words, got[1].first_word) == (2_000_004, 2_000_000)
    assert merkle.verified_manifest(df).filter("verified").count() == 2
