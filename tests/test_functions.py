import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from chainlake.functions import bytecode, hexes, scalars
from conftest import listed


def column(spark, expr, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_hex_integers(spark):
    texts = ["0x0", "0x000", "0xff", "0xFF", "zz", None, "0x", "0x" + "f" * 15, "0x" + "f" * 16]
    assert column(spark, hexes.hex_long, texts) == [0, 0, 255, 255, None, None, None, 16**15 - 1, None]


def test_hex_decimal_up_to_38_digits(spark):
    top = 10**38 - 1
    values = [1, 2**64, 2**100 + 7, top, top + 1, 2**128 - 1, 2**255]
    got = column(spark, hexes.hex_dec, [hex(v) for v in values])
    assert [None if g is None else int(g) for g in got] == [1, 2**64, 2**100 + 7, top, None, None, None]


def test_hex_double_and_text_up_to_256_bits(spark):
    values = [0, 1, 2**53 + 1, 10**30, 2**200 + 12345, 2**256 - 1000]
    texts = ["0x" + format(v, "064x") for v in values]
    assert column(spark, hexes.hex_text, texts) == [str(v) for v in values]
    odd = ["0x1_0", "-0x5", "1f", " 0x10 ", "0x" + "1" * 70, "0x", "", None]
    assert column(spark, hexes.hex_text, odd) == [None] * len(odd)
    for got, want in zip(column(spark, hexes.hex_dbl, texts), values):
        assert abs(got - float(want)) <= 1e-14 * float(want)


def test_words_and_addresses(spark):
    one, two = "ab" * 32, "cd" * 32
    words = column(spark, hexes.words, ["0x" + one + two, "0x" + one + "12", "0x", "", None])
    assert words == [["0x" + one, "0x" + two], ["0x" + one, "0x12"], [], [], []]
    got = column(spark, hexes.word_address, ["0x" + "0" * 24 + "AB" * 20, "0xABC", None])
    assert got == ["0x" + "ab" * 20, "0xabc", None]


def _decode58(text, size=34):
    number = 0
    for c in text:
        number = number * 58 + hexes.ALPHABET58.index(c)
    return number.to_bytes(size, "big").hex()


def test_content_id_round_trip(spark):
    digests = ["0x" + format(v, "064x") for v in (1, 2**200 + 9, 2**256 - 1)]
    for digest, text in zip(digests, column(spark, hexes.base58, digests)):
        assert text.startswith("Qm") and _decode58(text) == "1220" + digest[2:]
    assert column(spark, hexes.base58, ["0xzz", None, "0x1", "0x" + "0" * 66]) == [None] * 4
    short = column(spark, hexes.base58, ["0x", "0x00ff"])
    assert [_decode58(t, n) for t, n in zip(short, (2, 4))] == ["1220", "122000ff"]
    plan = spark.range(1).select(hexes.base58(F.lit("0x00")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def plain_selectors(text):
    """A walk over one code, instruction by instruction."""
    text = re.sub("^(0x)+", "", text or "")
    if len(text) % 2 or re.search("[^0-9a-fA-F]", text):
        return []
    code, found, at = bytes.fromhex(text), set(), 0
    while at < len(code) and not (code[at] == 0x5B and at):
        if code[at] == 0x63 and at + 4 < len(code):
            found.add("0x" + code[at + 1:at + 5].hex())
        at += 1 + (code[at] - 0x5F if 0x60 <= code[at] <= 0x7F else 0)
    return sorted(found)


def test_selectors_of_many_codes(spark):
    rng = random.Random(2)
    ops = ["00", "5b", "63", "60", "7f", "14", "64", "80"]
    codes = ["0x" + "".join(rng.choices(ops, [9, 1, 9, 3, 1, 9, 2, 9], k=rng.randint(0, 200))) for _ in range(400)]
    codes += ["0x" + "63aabbccdd" * 4000 + "5b" + "6311223344", "0x" + "00" * 70_000 + "6311223344", "0x63", "0x6", None]
    codes += ["0x" + "".join(rng.choices("0123456789abcdef", k=2 * rng.randint(0, 30_000))) for _ in range(20)]
    assert column(spark, bytecode.sighashes, codes) == [plain_selectors(c) for c in codes]


def test_selectors_stop_at_the_first_jump_target(spark):
    push4 = lambda s: "63" + s
    selectors = lambda *codes: column(spark, bytecode.sighashes, codes)
    code = "0x0x6080604052" + push4("70a08231") + "14" + "57" + push4("18160ddd") + "5b" + push4("deadbeef")
    # The operand of a longer push is data, whatever its bytes say.
    longer = "0x" + "65" + "63aabbccdd5b" + push4("01020304")
    assert selectors(code, longer, "0x63aabb", "0x5b63aabbccdd5b") == [
        ["0x18160ddd", "0x70a08231"], ["0x01020304"], [], ["0xaabbccdd"]]
    assert selectors(None, "0x", "", "0xzz", "0x" + "00" * 20) == [[]] * 5


def test_interface_flags(spark):
    twenty, nft = bytecode.ERC20, bytecode.ERC721 + [bytecode.TRANSFER]
    rows = [twenty, twenty[1:], nft, bytecode.ERC721, []]
    assert column(spark, bytecode.is_erc20, rows, "array<string>") == [True, False, False, False, False]
    assert column(spark, bytecode.is_erc721, rows, "array<string>") == [False, False, True, False, False]


def test_item_ids_need_all_parts(spark):
    rows = spark.createDataFrame([("h", 1), ("h", None), (None, 2)], "transaction_hash string, log_index int")
    got = [r[0] for r in rows.select(scalars.item_id("log")).collect()]
    assert got == ["log_h_1", None, None]


def test_text_and_time(spark):
    assert column(spark, scalars.clean_text, ["a\u0000b", None]) == ["ab", None]
    assert column(spark, scalars.bytes_text, [b"ok\x00", b"\xff\xfe"], "binary") == ["ok", None]
    assert column(spark, scalars.iso_text, ["2023-01-02T03:04:05.678Z", "1672628645000", "x"]) == [
        "2023-01-02 03:04:05", "2023-01-02 03:04:05", None]
    assert column(spark, scalars.pad_block, [7, 12345678901], "bigint") == ["0000000007", "12345678901"]
    assert column(spark, lambda c: scalars.or_unknown(c, True), ["", None, "x"]) == ["Unknown", "Unknown", "x"]


def test_gas_cost_overflow_is_null(spark):
    rows = spark.createDataFrame([(Decimal(10**20), Decimal(10**20)), (Decimal(21000), Decimal(10**9))], "a decimal(38,0), b decimal(38,0)")
    got = [r[0] for r in rows.select(scalars.gas_cost(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 21000 * 10**9 / 1e18]


def test_block_age_forms_cut_towards_zero(spark):
    ages = lambda mode: column(spark, lambda c: scalars.block_age(c, F.lit(100), mode), [100, 190, 100 + 28800 * 91], "bigint")
    assert ages("blocks") == [0, 0, 90]
    assert ages("days") == [-90, -89, 1]


def test_bin_25_falls_to_the_last_branch(spark):
    got = column(spark, scalars.bin_band, [24, 25, 26, 150, 499, 500], "int")
    assert got == ["1. Lowest", "6. Highest", "2. Low", "4. Experience", "5. High", "6. Highest"]


def test_fixed_text(spark):
    assert column(spark, scalars.fixed_text, [1234567.5, None, -0.25], "double") == [
        "1234567.5000000000", None, "-0.2500000000"]


def test_div10(spark):
    rows = spark.createDataFrame([(2.0, 3.0), (1.0, 0.0)], "a double, b double")
    assert listed(rows.select(F.round(scalars.div10(F.col("a"), F.col("b")), 10))) == [(0.6666666666,), (None,)]


def test_a_hex_value_is_read_by_short_methods(spark):
    """Eight fields of a row: one stage of them would pass the size up to which HotSpot compiles a method."""
    cases = {"0x": None, "0xg": None, None: None, "12": None, "0X0": 0, "0x" + "f" * 15: 16**15 - 1, "0x" + "f" * 16: 16**16 - 1,
             "0x" + "0" * 49 + "f" * 15: 16**15 - 1, "0x" + "0" * 50 + "f" * 15: None, "0x1" + "0" * 31: 16**31,
             "0x" + "0" * 32 + "f" * 32: None, "0x" + "0" * 31 + "1" + "0" * 32: None, "0x-1": None}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    found = {r.h: (r.l, r.d) for r in df.select("h", hexes.hex_long(F.col("h")).alias("l"), hexes.hex_dec(F.col("h")).alias("d")).collect()}
    for text, value in cases.items():
        assert found[text] == (value if value is not None and value < 16**15 else None, None if value is None else Decimal(value)), text
    assert len(hexes.hex_long(F.col("h"))._jc.toString()) < 300
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_long_conversions_agree_with_python(spark):
    rng = random.Random(5)
    values = [0, 1, 58**5 - 1, 58**5, 10**38, 2**256 - 1, *(rng.getrandbits(rng.randrange(1, 257)) for _ in range(300))]
    texts = ["0x" + format(v, "064x") for v in values]
    assert [_decode58(t) for t in column(spark, hexes.base58, texts)] == ["1220" + t[2:] for t in texts]
    assert column(spark, hexes.hex_text, texts) == [str(v) for v in values]


def test_a_content_id_takes_few_steps(spark):
    # A step for each limb of each piece, a hundred in all, would nest one fold in another.
    plan = spark.range(1).select(hexes.base58(F.sha2(F.col("id").cast("string"), 256)).alias("x"))
    assert plan._jdf.queryExecution().optimizedPlan().expressions().mkString().count("aggregate(") == 1
