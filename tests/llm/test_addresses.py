import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.llm import addresses
from tessera.llm.addressing import LONG, deletions, read_places, spelled_alike, within

SCHEMA = "address_id long, street1 string, street2 string, city string, state string, postal_code string"


def place(*fields):
    p = next(iter(read_places(*fields)), None)
    return p and (p.box, p.number, p.name, p.direction, p.kind, p.city, p.state, p.zip5, p.unit)


@pytest.mark.parametrize(
    "fields, want",
    [
        (("1708 So. Tanagermoor Ter", "# 2360", "St. Calder", "tx", "42326-0000"), (False, "1708", "TANAGERMOOR", "SOUTH", "TERRACE", "SAINTCALDER", "TX", "42326", "2360")),
        (("829,  FOUNDRYRIDGE CT", "47TH FLOOR", "N. MERROW", "PA", "PA 83931"), (False, "829", "FOUNDRYRIDGE", "", "COURT", "NORTHMERROW", "PA", "83931", "47TH")),
        (("Cupola House, 1144 Juniper Road E.", "Unit 5", "Thorn Spgs, IL 63110", None, None), (False, "1144", "JUNIPER", "EAST", "ROAD", "THORNSPRINGS", "IL", "63110", "5")),
        (("ATTN: LEGAL DEPT", "564 KETTLE PKY", None, "Colorado", None), (False, "564", "KETTLE", "", "PARKWAY", "", "CO", "", "")),
        (("394 ORCHARD PLZ", "FORT OSTLEDALE VA 33262", None, None, None), (False, "394", "ORCHARD", "", "PLAZA", "FORTOSTLEDALE", "VA", "33262", "")),
        (("P.  O. BOX 0770009", None, "X", "GA", "254610000"), (True, "770009", "", "", "", "X", "GA", "25461", "")),
        (("2278 N. Secoond Ln", None, "X", "CT", "7276"), (False, "2278", "2ND", "NORTH", "LANE", "X", "CT", "07276", "")), (("Post Office Box 12", "", "X", "Nowhere", "1"), (True, "12", "", "", "", "X", "", "", "")),
        (("SUITE 300, 2036 THIRD AVE", None, "X", "NY", None), (False, "2036", "3RD", "", "AVENUE", "X", "NY", "", "300")),
        ((None, None, "QUILL", "UT", "12345"), None), (("EXECUTIVE OFFICES", None, None, None, None), None), ((None,) * 5, None), (("SUITE 12", None, "X", "UT", None), None),
    ],
)
def test_reading(fields, want):
    assert place(*fields) == want


def test_deletions_meet():
    assert place("9" * 10_000, "x" * 100_000, "", "", "")[2] == "X" * 100_000 and len(deletions("X" * 100_000)) == 2
    for n in (8, LONG - 1, LONG, LONG + 1, LONG + 2, 700):  # also where spelled-out forms meet hashed ones
        word = "".join(chr(65 + k * k % 26) for k in range(n))
        for other in (word[: n // 2] + "?" + word[n // 2 :], word[:3] + "?" + word[4:], word[:-3] + word[-2] + word[-3] + word[-1]):
            assert set(deletions(word)) & set(deletions(other))
        assert not set(deletions(word)) & set(deletions(word[::-1]))
    assert set(deletions("kettle")) & set(deletions("ketttle")) and set(deletions("kettle")) & set(deletions("ekttle")) and set(deletions("kettle")) & set(deletions("kattle"))
    assert deletions("3RD") == ["3RD"]


def plain_edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_errors_between_names():
    r = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(r.choice("AB") for _ in range(r.randrange(0, 8))) for _ in range(2))
        for limit in (1, 2, 4):
            assert within(a, b, limit) == (plain_edits(a, b) <= limit)
    assert within("X" * 50_000, "X" * 25_000 + "Y" * 2 + "X" * 24_998, 2) and not spelled_alike("MARKET", "MARKHAM") and not spelled_alike("MAPLE", "APPLE") and spelled_alike("TANAGERMOR", "TNAAGERMOOR")


def test_all_plausible_readings():
    names = lambda *f: {(p.name, p.direction, p.kind) for p in read_places(*f, None, "X", "NY", None)}
    assert names("12 N St") == {("N", "", "STREET"), ("NORTH", "", "STREET")} and names("12 North Street") == {("NORTH", "", "STREET")}
    assert names("9 St James Rd") == {("STJAMES", "", "ROAD"), ("SAINTJAMES", "", "ROAD")}
    assert names("9 Avenue E") == names("9 Ave East") == {("AVENUE", "EAST", "")} and names("9 Ave C") == {("0AVENUEC", "", "")} and not spelled_alike("0AVENUEC", "0AVENUED")
    assert names("5 North Park Rd") == names("5 Park Rd North") == {("PARK", "NORTH", "ROAD")}
    assert [(p.box, p.number) for p in read_places("12 Elm St", "PO Box 7", "X", "NY", None)] == [(False, "12"), (True, "7")]
    assert [p.part for x in ("37-10 30th St", "12A Main St", "12-B Main St", "012 1/2 Main St", "12 Main St") for p in read_places(x, None, None, None, None)] == ["-10", "~A", "~B", "/1/2", ""]


def test_look_alikes_stay_apart(spark):
    streets = ["37-10 30TH ST", "37-20 30TH ST", "12A MAIN ST", "12B MAIN ST", "100 MARKET ST", "100 MARKHAM ST", "100 MAPLE ST", "100 APPLE ST", "12 1/2 OAK ST", "12 OAK ST", "12 1/4 OAK ST"]
    df = spark.createDataFrame([(k, x, None, "CALDER", "TX", "42326") for k, x in enumerate(streets)], SCHEMA)
    assert sorted(rows(addresses.place_pairs(df)[0])) == [(8, 9), (9, 10)]  # a record that leaves the fraction out may be either


def test_readings_meet(spark):
    data = [
        (1, "12 N St", None, "CALDER", "TX", "42326"), (2, "12 NORTH STREET", None, "CALDER", "TX", "42326"), (3, "9 St James Rd", None, "CALDER", "TX", "42326"), (4, "9 SAINT JAMES ROAD", None, "CALDER", "TX", "42326"),
        (5, "700 Elm St", "PO Box 77", "CALDER", "TX", "42326"), (6, "P.O. BOX 77", None, "CALDER", "TX", "42326"), (7, "700 ELM STREET", None, "CALDER", "TX", "42326"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert sorted(rows(addresses.place_pairs(df)[0])) == [(1, 2), (3, 4), (5, 6), (5, 7)]
    assert addresses.places(df).count() == 7


def brute_pairs(data):
    """Every two records compared, then closed: what the hashes must not lose. Records tell all their parts."""
    told = {k: read_places(*f)[0] for k, *f in data}
    alike = lambda a, b, chain: a.number == b.number and a.zip5 == b.zip5 and a.kind == b.kind and a.direction == b.direction and spelled_alike(a.name, b.name, chain)
    label = {k: k for k in told}
    for _ in told:
        for x in told:
            for y in told:
                if alike(told[x], told[y], False):
                    label[x] = label[y] = min(label[x], label[y])
    return sorted((x, y) for x in told for y in told if x < y and label[x] == label[y] and alike(told[x], told[y], True))


def test_pairs_equal_brute_force(spark):
    r = random.Random(11)
    streets = ["TANAGERMOOR", "KETTLE", "JUNIPERSIDE", "FOUNDRYRIDGE", "MAPLE", "APPLE"]

    def wrong(word, times):
        for _ in range(times):
            k = r.randrange(1, len(word) - 1)
            word = r.choice([word[:k] + word[k + 1 :], word[:k] + r.choice("AEIX") + word[k:], word[:k] + r.choice("AEIX") + word[k + 1 :], word[: k - 1] + word[k] + word[k - 1] + word[k + 1 :]])
        return word

    data = [(k, f"{r.choice([12, 14])} {wrong(r.choice(streets), r.choice([0, 0, 1, 1, 2]))} {r.choice(['ST', 'AVENUE'])}", None, "CALDER", "TX", r.choice(["42326", "63110"])) for k in range(160)]
    first = {}
    data = [first.setdefault(d[1:], d) for d in data if d[1:] not in first]
    assert sorted(rows(addresses.place_pairs(spark.createDataFrame(data, SCHEMA))[0])) == brute_pairs(data)


def test_pairs(spark):
    data = [
        (1, "1708 SOUTH TANAGERMOOR TERRACE", "SUITE 2360", "CALDERFORD", "TX", "42326"),
        (2, "1708 So. Tanagermor Ter", "# 9", "Calderford", "TX", None),  # a typo, no zip
        (3, "1708 S TANAEGRMOOR", "SUITE 2360", "CALDRFORD", None, "42326-1111"),  # another typo, no type
        (4, "1708 SOUTH TANAGERMOOR PARKWAY", "SUITE 1", "CALDERFORD", "TX", "42326"),  # another street
        (5, "1709 SOUTH TANAGERMOOR TERRACE", None, "CALDERFORD", "TX", "42326"),  # another number
        (6, "1708 NORTH TANAGERMOOR TERRACE", None, "CALDERFORD", "TX", "42326"),  # another direction
        (7, "1708 SOUTH TANAGERMOOR TERRACE", None, "OSTLE", "IL", "99999"),  # another town
        (8, "PO BOX 1708", None, "CALDERFORD", "TX", "42326"), (9, "P O BOX 1708", None, "Calderford", "TX", "42326"), (10, "POB 1709", None, "CALDERFORD", "TX", "42326"),
        (11, "1708 SOUTH TANAGERMOOR TERRACE", "SUITE 2360", "CALDERFORD", "TX", "42326"),  # exact copy
        (12, None, None, "CALDERFORD", "TX", "42326"), (13, None, None, None, None, None), (None, "1708 SOUTH TANAGERMOOR TERRACE", None, "CALDERFORD", "TX", "42326"),
        (14, "1708 SOUTH TANAGERMOOR", "SUITE 1", "CALDERFORD", "TX", "42326"),  # the type by its suite: the parkway
    ]
    df = spark.createDataFrame(data, SCHEMA).withColumn("id", F.lit(1)).withColumn("label", F.lit("x")).withColumn("hash", F.lit(0))
    pairs, _, _ = addresses.place_pairs(df)
    assert sorted(rows(pairs)) == [(1, 2), (1, 3), (2, 3), (4, 14), (8, 9)]
    places = {r.address_id: r.place for r in addresses.places(df).collect()}
    assert places == {1: 1, 2: 1, 3: 1, 11: 1, 4: 4, 14: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10}
    assert addresses.place_pairs(df.filter("false"))[0].count() == 0


def test_closure_of_a_long_chain(spark):
    order = [1, 12, 3, 11, 5, 10, 7, 9, 2, 8]
    read = spark.createDataFrame([(k,) for k in [*order, 20, 21, 21]], "id long")
    links = spark.createDataFrame([(min(p), max(p)) for p in [*zip(order, order[1:]), (20, 21)]], "a_id long, b_id long")
    assert {r.id: r.label for r in addresses.labels(read, links).collect()} == {**dict.fromkeys(order, 1), 20: 20, 21: 20}
    assert addresses.labels(read, links.filter("false")).filter("id <> label").count() == 0


def test_two_misspelled_records_without_a_clean_one(spark):
    data = [
        (1, "1642 Juinperside Rd", None, "Calder", "TX", "42326"), (2, "1642 JUNIPERSIIDE RD", None, "CALDER", "TX", "42326"),  # ends differ too
        (3, "77 Tanagermor Rd", None, "Ostledale", "IL", "63110"), (4, "77 TNAAGERMOOR RD", None, "Ostledale", None, None),  # no zip, no state
        (5, "88 Foundryrigde Ln", None, "Merowfield", None, None), (6, "88 FOUNDRYRIDGE LN", None, "Merrowfield", "PA", "83931"),  # street and city
        (7, "12 CEDAR ST", None, "CALDER", "TX", "42326"), (8, "12 CIDER ST", None, "CALDER", "TX", "42326"), (9, "12 CENTER ST", None, "CALDER", "TX", "42326"),
        (10, "1642 JUNIPERDALE RD", None, "OTHER", "NY", "10001"), (11, "1642 UNIPERSIDE RD", None, "OTHER", "NY", "10001"),  # other names
    ]
    pairs, _, _ = addresses.place_pairs(spark.createDataFrame(data, SCHEMA))
    assert sorted(rows(pairs)) == [(1, 2), (3, 4), (5, 6)]
