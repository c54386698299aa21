import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filanda.llm import personal_data
from filanda.llm.personal_data import feistel, find_items, found_personal_data, permute_date, permute_format, permute_phone, permute_tax_code, redact, redacted_texts, tax_check

KEY = b"a key"


def kinds(text):
    return sorted({k for _, _, k in find_items(text)})


@pytest.mark.parametrize(
    "text,want",
    [
        ("Scrivere a marta.rossi+x@mx.ombrelia.example.", ["email"]), ("a helpdesk[at]studio-brisa.invalid oppure", ["email"]), ("info (at) mx punto ombrelia punto example", ["email"]), ("A.B@NORDAVIA.EXAMPLE", ["email"]),
        ("tel. +39 0329 385124", ["phone"]), ("al 0329/146804 solo", ["phone"]), ("al 0329.14852", ["phone"]), ("call 0329 - 845 214 int. 73 now", ["phone"]), ("(0329) 18.45.33.", ["phone"]), ("al 3009294166.", ["phone"]), ("tel. 300 48 27 122.", ["phone"]), ("+44 1632 960017", ["phone"]), ("0039 300-3789075", ["phone"]),
        ("C.F. TBS TVC 50C18 Z904V.", ["identity"]), ("(RBTSNL04H15Z940D)", ["identity"]), ("documento CA 61136 ZS,", ["identity"]), ("documento YC0911068.", ["identity"]), ("document 965-13-7799", ["identity"]), ("AV5920373N", ["identity"]), ("mtctdp28t44z914x", ["identity"]),
        ("in V.le dell'Ombra Lunga 178, Torrelunga", ["address"]), ("via degli Arrotini n. 66.", ["address"]), ("Corso Cava Rossa, n° 40/B.", ["address"]), ("at 140 Quarrystone Lane, Harrowmere", ["address"]), ("Largo Tigli Bassi 155 - 99659 Valdoria (VQ)", ["address"]), ("Piazza San Tommaso 5", ["address"]),
        ("Approvato da Marta Vanzironne in data 25/02/2023.", ["person"]), ("Il referente è NENPIDEMBI Ivano.", ["person"]), ("Celnebicce, Robert, il test", ["person"]), ("Assegnato a Sig. Gercemesso per competenza.", ["person"]), ("da K. Ninlifazza, il test", ["person"]), ("Firmato: Leo. Forganunni", ["person"]), ("Noemi E. Goncefagne", ["person"]), ("Presenti: Puero Melbonagne; Ugo Zormanolfi.", ["person"]), ("Il referente è Cenvarosso A..", ["person"]), ("NICOLÒ SELVAMIRDO signed the report.", ["person"]),
    ],
)
def test_found(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize(
    "text",
    [
        "P.IVA 02321938247 del fornitore Groxderete Industriale S.p.A..", "Con ordine n. 2493652 la direzione", "Il seriale S/N 4475-0988753-90 corrisponde al lotto 3550505829.", "La chiave XKQW-548A4-ZZ60 attiva", "dalla rete 10.53.255.10/24", "il 10.07.2020 e il 05/01/2024",
        "nella fascia 548-112 del", "EUR 398.232", "via VPN 292", "tramite via console", "Per il corso base 706 e il largo consumo", "dopo un corso di formazione 2024", "Il gruppo @team-rete risponde", "185 pezzi @ € 9.119", "Alivrefulen Ing. S.r.l. ha censito", "insieme a Drexdozakex International Scarl", "modulo Talmira 9.11.32", "ticket INC0902880",
        "Vale lo SLA in vigore.", "", "lo SLA di Pian d'Orso", "will document 662 workstations", "Piazza San Tommaso è chiusa", "Nella fase 12 del contratto",
    ],
)
def test_not_found(text):
    assert kinds(text) == []


def test_names_in_mailboxes_do_not_count():
    assert kinds("marta.vanzironne@tekmora.test") == ["email"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Sentito l'ing. Gercemesso.", ["person"]), ("Nota dell'arch. Gercemesso.", ["person"]), ("Firma (ing. Gercemesso)", ["person"]), ("ing. Gercemesso", ["person"]), ("Ing Gercemesso", ["person"]), ("(dr. Gercemesso)", ["person"]), ("Il rag Gercemesso", ["person"]),
        ("In P. zza Torrelunga 12", ["address"]), ("In p zza Torrelunga 12", ["address"]), ("In pza Torrelunga 12", ["address"]), ("In p za Torrelunga 12", ["address"]), ("at 140 Quarrystone\nLane, Harrowmere", ["address"]),
    ],
)
def test_prefilters_lose_nothing(text, want):
    assert kinds(text) == want


@given(st.integers(2, 10**7), st.integers(0, 10**9))
@settings(max_examples=60, deadline=None)
def test_feistel_is_a_permutation(size, x):
    x %= size
    y = feistel(x, size, KEY)
    assert 0 <= y < size and feistel(y, size, KEY, back=True) == x


def test_feistel_hits_all():
    assert sorted(feistel(i, 500, KEY) for i in range(500)) == list(range(500))


def test_formats_stay():
    v = "+39 0329 385124"
    assert permute_format(permute_format(v, KEY), KEY, back=True) == v and permute_format(v, KEY) != v
    assert permute_format("CA 61136 zs", KEY)[2] == " " and permute_format("CA 61136 zs", KEY)[3:8].isdigit()
    code = "RSSMRA85T10A562"
    code += tax_check(code)
    other = permute_tax_code(code, KEY)
    assert other != code and tax_check(other[:15]) == other[15] and permute_tax_code(other, KEY, back=True) == code
    assert permute_tax_code("TBS TVC 50C18 Z904V", KEY)[3] == " "
    assert permute_date(permute_date("28/02/1980", KEY), KEY, back=True) == "28/02/1980" and permute_date("31/02/1980", KEY) == "31/02/1980"


def test_redact():
    text = "Contattare Marta Vanzironne al 0329/146804 oppure m.v@tekmora.test, nata il 03/04/1980."
    out, found = redact(text, KEY)
    assert found == ["email", "phone", "person"] and "Vanzironne" not in out and "146804" not in out and "03/04/1980" not in out
    assert out.startswith("Contattare [PERSON ") and " al [PHONE " in out
    again = redact("VANZIRONNE Marta scrive", KEY)[0]
    assert again.split("]")[0] == out[11:].split("]")[0]  # equal persons, equal pseudonyms
    assert redact(None, KEY) == (None, []) and redact("", KEY) == ("", [])
    assert redact(text, b"other")[0] != out


def test_tables(spark):
    s = spark.createDataFrame([(1, "a@b.example", ["0329/146804 e 0329/146805", None], 1), (1, "a@b.example", ["0329/146804 e 0329/146805", None], 1), (2, None, None, 1), (3, "x " * 100_000 + "a@b.example", [""], 1)], "section_id long, preview_start string, paragraphs array<string>, kind int")
    t = spark.createDataFrame([(7, "Firmato: Marta Vanzironne", 1), (8, None, 1)], "diff_id long, text_preview string, tab int")
    assert sorted(map(tuple, found_personal_data(s, t, KEY).collect())) == [("sections", 1, -1, "email"), ("sections", 1, 0, "phone"), ("sections", 3, -1, "email"), ("taxonomy_diff", 7, -1, "person")]
    assert redacted_texts(s, t, KEY).count() == 6
    assert found_personal_data(s.limit(0), t.limit(0), KEY).count() == 0


@pytest.mark.parametrize("text", ["Chiamare Wei Zhang al mattino", "Referente: Fatima El Amrani.", "Contact: Olga Petrova, ok", "Firmato da: Xavier Dubois", "Ask for Chidi van der Okafor today", "Rivolgersi a Dosmarin Popescu in sede"])
def test_names_on_no_list_by_their_cue(text):
    assert kinds(text) == ["person"]


@pytest.mark.parametrize("text", ["Referente: Ufficio Acquisti Sede", "Contattare Servizi Generali S.r.l. in sede", "Contact: SLA Manager", "Chiamare il numero verde", "Firma: ", "il sistema Dosmarin ha"])
def test_cues_without_a_name(text):
    assert kinds(text) == []


def test_phones_of_two_writings_stay_linked():
    digits = lambda v: "".join(c for c in permute_phone(v, KEY).removeprefix("+39").removeprefix("0039") if c.isdigit())
    same = ["+39 02 5551234", "+39025551234", "02 555 1234", "02/5551234", "0039 02-555.12.34", "(02) 5551234"]
    assert len({digits(v) for v in same}) == 1 and digits(same[0]) != "025551234" and digits("02 5551235") != digits(same[0])
    assert permute_phone("+39 02 5551234", KEY)[:5] == "+39 0" and permute_phone("+44 1632 960017", KEY).startswith("+44 1")
    for v in same:
        assert permute_phone(permute_phone(v, KEY), KEY, back=True) == v
    assert permute_phone("02 5551234 int. 73", KEY).split(" int. ")[0] == permute_phone("02 5551234", KEY)


def test_accounts_are_replaced_but_not_reported():
    out, found = redact("IBAN IT60X0542811101000000123456 e carta 4111 1111 1111 1111 e lotto 4111 1111 1111 1112", KEY)
    assert found == [] and "0542811101000000123456" not in out and "4111 1111 1111 1111" not in out and out.endswith("4111 1111 1111 1112") and out.count("[ACCOUNT ") == 2


def test_rows_come_from_the_redaction(spark, monkeypatch):
    s = spark.createDataFrame([(1, "tel. 0329/146804", None)], "section_id long, preview_start string, paragraphs array<string>")
    t = spark.createDataFrame([], "diff_id long, text_preview string")
    both = redacted_texts(s, t, KEY).first()
    assert both.kinds == ["phone"] and both.text == f"tel. [PHONE {permute_phone('0329/146804', KEY)}]"
    monkeypatch.setattr(personal_data, "redacted_texts", lambda *a: redacted_texts(*a).limit(0))
    assert found_personal_data(s, t, KEY).count() == 0
