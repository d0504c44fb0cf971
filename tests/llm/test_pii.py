import hashlib
import re

from helpers import documents, edge_texts

from strata.llm import pii as P

from pyspark.sql import functions as F


def base(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == "phone" or P.luhn(d)):
                out.append((kind, *m.span()))
    return ",".join("%s:%d:%d" % x for x in sorted(out, key=lambda x: (x[1], P.KINDS.index(x[0]))))


TEXTS = edge_texts() + [
    "mail a.b+c@x-y.co.uk, é d@e.f@g.h and @no.one or x@y",
    "ip 1.2.3.4.5 256.1.1.1 010.0.0.255 1.2.3 and 9.9.9.9",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 0000000000000000000000, 5500000000000004",
    "call +1 (624) 555-2408 or +44 20 7946 0958. +12 +1234567890123456 +1 (826) 555-4081 190.137.2.14",
    "phone (212) 555-0147 and call 212-555-0147; order 212-555-0147x", "ssn 123-45-6789, ssn 000-45-6789",
    "iban GB82 WEST 1234 5698 7654 32 x", "write to jane (at) example (dot) org", "hash fe42fba524357e6738 build 10.20.30.40",
    "9" * 3000, "1." * 3000, "a" * 4000 + "@b.cc", "+" + "1 " * 2000, "x@" * 1500,
] + [f"email user{i}@mail{i % 5}.com phone +1 (212) 555-{1000 + i} from 10.1.2.{i}" for i in range(60)]


def test_base_spans_against_plain_patterns(spark):
    docs = documents(spark, TEXTS).withColumn("spans", F.lit("clash"))
    rows = P.find(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        b = base(TEXTS[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(b.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in b.split(",") if x]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [kinds.count(k) for k in P.BASE]
        found = r["spans"].split(",")
        assert all(x in found for x in b.split(",") if x)
    by = {r["doc_id"]: r["spans"] for r in rows}
    assert "phone" in by[TEXTS.index("phone (212) 555-0147 and call 212-555-0147; order 212-555-0147x")]
    assert by[TEXTS.index("hash fe42fba524357e6738 build 10.20.30.40")].count(":") <= 2


def test_em_finds_the_unreliable_labeler():
    """Votes drawn from known reliabilities: EM and the classifier recover the truth on held-out draws."""
    import random
    rnd = random.Random(4)
    right = [0.95, 0.9, 0.85, 0.55, 0.8]

    def draw():
        y = rnd.random() < 0.5
        votes = [(1 if (rnd.random() < p) == y else -1) if rnd.random() < 0.8 else 0 for p in right]
        return y, (0, *votes, 2, 2)

    train = [draw()[1] for _ in range(4000)]
    model = P.fit_patterns(sorted({f: train.count(f) for f in set(train)}.items()))
    truth = [draw() for _ in range(1000)]
    assert sum((model.probability(f) >= 0.5) == y for y, f in truth) > 900
    for_yes = [model.reliability[1][j][2] / (model.reliability[1][j][0] + model.reliability[1][j][2]) for j in range(5)]
    assert min(range(5), key=lambda j: for_yes[j]) == 3


def test_redaction_and_empty(spark):
    docs = documents(spark, TEXTS)
    out = {r["doc_id"]: r["text"] for r in P.redact(docs).collect()}
    assert out[0] is None and out[3] == "one"
    assert "@" not in out[len(TEXTS) - 1] and "[email]" in out[len(TEXTS) - 1]
    assert P.find(docs.limit(0)).collect() == []


def test_spans_without_digits(spark):
    spelled, ipv6 = "write to jane (at) example (dot) org", "from address fe:dc:ba:ab:cd:ef:fa:ce here"
    docs = documents(spark, TEXTS + [ipv6])
    found = {r["doc_id"]: r["spans"] for r in P.find(docs).collect()}
    out = {r["doc_id"]: r["text"] for r in P.redact(docs).collect()}
    assert found[TEXTS.index(spelled)] == "email:9:36" and out[TEXTS.index(spelled)] == "write to [email]"
    assert found[len(TEXTS)] == "ip:13:36" and out[len(TEXTS)] == "from address [ip] here"
