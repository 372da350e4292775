from __future__ import annotations

import datetime as dt
import re

import pytest
from skywarden.llm.pseudonyms import Feistel, Pseudonyms, luhn_digit, pseudonymous

KEY = b"test key"


@pytest.mark.parametrize("size", [1, 2, 7, 10, 97, 1000, 4096])
def test_permutation_and_way_back(size):
    net = Feistel(KEY, "t", size)
    image = [net(x) for x in range(size)]
    assert sorted(image) == list(range(size)) and [net(y, False) for y in image] == list(range(size))
    assert size < 90 or [Feistel(b"other", "t", size)(x) for x in range(size)] != image


@pytest.fixture(scope="module")
def made():
    return Pseudonyms(KEY)


def luhn_ok(digits):
    return luhn_digit(digits[:-1]) == digits[-1]


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "378282246310005"])
def test_cards_stay_valid(made, text):
    new, n = made.text(f"card {text}, thanks")
    found = re.search(r"card (.*), thanks", new).group(1)
    assert n == 1 and found != text and re.sub(r"\d", "9", found) == re.sub(r"\d", "9", text)
    assert luhn_ok(re.sub(r"\D", "", found))


def test_layouts_of_one_value_stay_linked(made):
    one, two = made.text("4111 1111 1111 1111")[0], made.text("4111111111111111")[0]
    assert one.replace(" ", "") == two
    days = [made.text(x)[0] for x in ("2021-03-04", "04.03.2021", "03/04/2021")]
    assert days[0] == f"{days[1][6:]}-{days[1][3:5]}-{days[1][:2]}" == f"{days[2][6:]}-{days[2][:2]}-{days[2][3:5]}"
    dt.date.fromisoformat(days[0])
    phones = {re.sub(r"\D", "", made.text(x)[0]) for x in ("+1 (918) 555-3922", "+1-918-555-3922", "+1 918 555 3922")}
    assert len(phones) == 1


@pytest.mark.parametrize("text", [
    "9807915762804490", "2024-02-30", "31/31/2020", "1.2.3.4.5", "999.1.1.1", "000-12-3456", "666-12-3456", "12-34", "1234567",
    "DE89 3704 0044 0532 0130 01", "no @ sign", "a@b", "plain words only", "2024", "3.14159265358979", "v1.2.3"])
def test_what_fails_its_check_stays(made, text):
    assert made.text(text) == (text, 0)


@pytest.mark.parametrize("text", [
    "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "123-45-6789", "jane.doe_7@mail.example.com", "192.168.10.254",
    "+1 (918) 555-3922", "+49 30 1234567", "415-555-0199", 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"',
    "password: hunter22x", "jürgen.müller@firma.de", "1985-07-30"])
def test_found_and_replaced_in_place(made, text):
    new, n = made.text(f"see {text} here")
    assert n == 1 and len(new) == len(text) + 9 and new != f"see {text} here" and new.startswith("see ")
    # What looks like a number looks like one afterwards, and going on is stable.
    assert made.text(f"see {text} here") == (new, n) and Pseudonyms(KEY).text(f"see {text} here") == (new, n)


LAYOUTS = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%d.%m.%Y", "%d-%m-%Y", "%d/%m/%Y", "%m/%d/%Y"]


def test_every_date_in_every_layout_and_back(made):
    """No two texts of a layout share a pseudonym, a date has one pseudonym in all layouts, and the key leads back."""
    from skywarden.llm.pseudonyms import _date

    def forth(kind, size, x):
        return made.network(kind, size)(x)

    def back(kind, size, x):
        return made.network(kind, size)(x, False)

    days = [dt.date(1900, 1, 1) + dt.timedelta(n) for n in range(73_049)]
    assert days[-1] == dt.date(2099, 12, 31)
    of_day = {d: _date(d.isoformat(), forth) for d in days}
    assert len(set(of_day.values())) == len(days)
    for layout in LAYOUTS[1:]:
        texts = {d.strftime(layout).zfill(10): d for d in days[::7]}
        for text, d in texts.items():
            new = _date(text, forth)
            assert _date(new, back) == text
            if layout == "%d/%m/%Y" and d.day <= 12:
                # Written day first, but read month first, like every text of this kind.
                d = dt.date(d.year, d.day, d.month)
            assert dt.datetime.strptime(new, "%m/%d/%Y" if layout == "%d/%m/%Y" and d.day <= 12 else layout).date(
                ).isoformat() == of_day[d]


@pytest.mark.parametrize("text", [
    "+33 1 23 45 67 89", "+33 6 11 22 33 44", "+33123456789", "+49 30 12345678", "+353 1 234 5678", "+7 495 123 4567",
    "+44 20 7946 0958"])
def test_country_codes_stay(made, text):
    from skywarden.llm.pseudonyms import _ONE_DIGIT, _TWO_DIGITS

    new, n = made.text(f"call {text} now")
    digits = re.sub(r"\D", "", text)
    code = 1 if digits[0] in _ONE_DIGIT else 2 if digits[:2] in _TWO_DIGITS else 3
    assert n == 1 and re.sub(r"\D", "", new)[:code] == digits[:code] and re.sub(r"\D", "", new) != digits
    assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", f"call {text} now")


@pytest.mark.parametrize("text", [
    "DE89 3704 0044 0532 0130 00", "4111-1111-1111-1111", "123-45-6789", "192.168.10.254", "+49 30 1234567", "(415) 555-0199",
    "jürgen.müller@firma.de", "Жанна.д@pochta.example.org", "31.12.1999", 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"'])
def test_the_key_leads_back(made, text):
    new, n = made.text(f"see {text} here")
    assert n == 1 and new != f"see {text} here"
    assert Pseudonyms(KEY, back=True).text(new) == (f"see {text} here", 1)


def test_letters_of_other_alphabets_are_permuted(made):
    names = [f"{a}{b}x" for a in "àéîöûß" for b in "жщю"]
    new = {made.text(f"{n}@firma.de")[0] for n in names}
    assert len(new) == len(names) and all(len(n) == 12 for n in new)


def test_iban_keeps_its_check(made):
    new = made.text("DE89 3704 0044 0532 0130 00")[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1


@pytest.mark.parametrize("text,value", [
    ("card 4111 1111 1111 1111 12/28", "4111 1111 1111 1111"), ("card 4111 1111 1111 1111 123 cvv", "4111 1111 1111 1111"),
    ("4111111111111111 12/28", "4111111111111111"), ("4111-1111-1111-1111-12/28", "4111-1111-1111-1111"),
    ("no 12 4111 1111 1111 1111", "4111 1111 1111 1111"), ("no 17-4111-1111-1111-1111", "4111-1111-1111-1111"),
    ("1235 4111 1111 1111 1111 12/28", "4111 1111 1111 1111"),
    ("BE68 5390 0754 7034 EUR", "BE68 5390 0754 7034"), ("BE68539007547034 EUR 5", "BE68539007547034"),
    ("AT61 1904 3002 3457 3201 EUR", "AT61 1904 3002 3457 3201"), ("BE68 5390 0754 7034 PAID", "BE68 5390 0754 7034"),
    ("ES91 2100 0418 4502 0005 1332 BIC", "ES91 2100 0418 4502 0005 1332"),
    ("AB13 BE68 5390 0754 7034 EUR", "BE68 5390 0754 7034")])
def test_other_groups_beside_a_number(made, text, value):
    alone, _ = made.text(value)
    assert alone != value and made.text(text) == (text.replace(value, alone), 1)


def test_secrets_without_digits_and_long_ones(made):
    bare, n = made.text("say password=correcthorse twice")
    assert n == 1 and "correcthorse" not in bare and made.text("say password=correcthorse twice 1")[0] == bare + " 1"
    secret = "".join(chr(97 + i * i % 26) + str(i % 10) + "K" for i in range(167))
    for long in (secret, "5" + "ab9" * 70, secret * 200):
        new, n = made.text(f"token: {long}.")
        assert n == 1 and len(new) == len(long) + 8
        assert all(new[i:i + 20] != long[i - 7:i + 13] for i in range(7, len(long) - 13, 20))


def test_rows(spark, edge_docs, no_docs):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", 5), (2, None, 5), (None, "", 5), (1, "mail a.b@c.de now", 5)],
                                 "doc_id long, text string, n_replaced int")
    rows = pseudonymous(docs, KEY).collect()
    assert [r.n_replaced for r in rows] == [1, 0, 0, 1] and rows[0].text == rows[3].text != "mail a.b@c.de now"
    assert pseudonymous(edge_docs, KEY).select(edge_docs.columns).collect() == edge_docs.collect()
    assert pseudonymous(no_docs, KEY).count() == 0
    with pytest.raises(ValueError):
        pseudonymous(docs, b"")
