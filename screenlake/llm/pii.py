"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.llm.common import text_of

# The kinds in report order and their patterns. Runs are possessive, a start may not lie
# inside a run, and runs of too few digits for a card are no match: that changes no confirmed span and
# keeps long runs linear.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?!\w)",
    "ssn": r"(?<!\w)[0-9]{3}-[0-9]{2}-[0-9]{4}(?!\w)",
}
# A text without a match of this, far cheaper to find, has none of the pattern.
NEEDLES = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"-[0-9]{2}-",
}
# Words nearby that make a kind likelier, in English, German, French and Spanish. Upper case is
# spelled out beyond a-z.
CONTEXT = {
    "email": "mails?|e-mails?|emails?|contact|write|inbox|kontakt|schreiben|schreib|anschrift|postfach|courriel|courrier|contactez|[éÉe]crire"
             "|[éÉe]crivez|correo|contacto|escribir|escriba|escribe|buz[óÓo]n",
    "ip": "ip|ipv4|host|address|addresses|server|login|logged|network|adresse|rechner|netz|netzwerk|angemeldet|serveur|h[ôÔo]te|r[éÉe]seau|connexion"
          "|direcci[óÓo]n|servidor|red|equipo|conexi[óÓo]n",
    "card": "cards?|visa|mastercard|amex|credit|debit|payment|pay|paid|karte|kartennummer|kreditkarte|zahlung|bezahlt|bankkarte|carte|cr[éÉe]dit|paiement|paye[rz]?"
            "|d[éÉe]bit|bancaire|tarjeta|cr[éÉe]dito|d[éÉe]bito|pago|pagar|pagado",
    "phone": "phone|telephone|tel|call|mobile|fax|cell|dial|telefon|telefonnummer|anruf|anrufen|rufnummer|handy|mobil|durchwahl|t[éÉe]l|t[éÉe]l[éÉe]phone"
             "|appel|appele[rz]|portable|t[éÉe]l[éÉe]copie|tel[éÉe]fono|m[óÓo]vil|celular|llamar|llame|llama",
    "iban": "iban|bank|account|transfer|swift|bic|konto|kontonummer|bankverbindung|[üÜu]berweisung|banque|compte|virement|rib|banco|cuenta|transferencia",
    "ssn": "ssn|social|security|taxpayer|sozialversicherung|sozialversicherungsnummer|steuernummer|sociale|s[éÉe]curit[éÉe]|contribuable|seguridad|contribuyente",
}
# Score of a confirmed span without and with a context word; added kinds need the threshold.
SCORES = {"email": (0.9, 1.0), "ip": (0.6, 0.9), "card": (0.8, 1.0), "phone": (0.6, 0.9), "iban": (0.8, 1.0), "ssn": (0.3, 0.8)}
THRESHOLD = 0.5
NEARBY = 40
# So many matches before and after a span hold all characters nearby: none is shorter than 4.
PIECES = NEARBY // 4
# Matches whose positions are summed together; no result depends on it.
BLOCK = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True if the digits of the value pass Luhn's check."""
    digits = F.split(F.reverse(_digits(value)), "")
    weighed = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(value: Column) -> Column:
    """True if the letters and digits of the value, first four at the end, are 1 modulo 97."""
    bare = F.regexp_replace(value, " ", "")
    turned = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (rest * 10 + c.cast("int")) % 97).when(c == "", rest).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^[0-9]{1,3}$")
                        & (F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 4).cast("int") <= 255))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "iban":
        return mod97(value)
    if kind == "ssn":
        area, group, serial = F.substring(value, 1, 3), F.substring(value, 5, 2), F.substring(value, 8, 4)
        return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    return F.lit(True)


def _placed(pieces: Column) -> Column:
    """(start, end, hit, at) of every (gap, hit), at its place in the array from 0, by running sums of their lengths.

    Sums run over blocks first and inside blocks then, so that texts with very many matches stay cheap.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int"))
    block = lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK))
    width = lambda x: F.length(x["gap"]) + F.length(x["hit"])
    widths = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda at, x: at + width(x)))
    firsts = F.aggregate(widths, F.array(F.lit(0)), lambda done, w: F.concat(done, F.array(F.element_at(done, -1) + w)))
    none = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, hit: STRING, at: INT>>)")

    def place(b: Column, state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), (b * BLOCK + F.size(state["spans"])).alias("at"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    inside = F.transform(
        blocks,
        lambda b: F.aggregate(
            block(b), F.struct(F.element_at(firsts, b + 1).alias("at"), none.alias("spans")), lambda s, x: place(b, s, x), lambda s: s["spans"]
        ),
    )
    return F.when(F.size(pieces) > 0, F.flatten(inside))


def _nearby(pieces: Column, at: Column) -> tuple[Column, Column]:
    """The NEARBY characters of the text before and after a match, across the matches next to it."""
    first = F.greatest(at - PIECES, F.lit(0))
    ahead = F.transform(F.slice(pieces, first + 1, at - first), lambda x: F.concat(F.right(x["gap"], F.lit(NEARBY)), F.right(x["hit"], F.lit(NEARBY))))
    before = F.concat(F.array_join(ahead, ""), F.right(F.get(pieces, at)["gap"], F.lit(NEARBY)))
    behind = F.transform(
        F.slice(pieces, at + 2, F.lit(PIECES + 1)), lambda x: F.concat(F.left(x["gap"], F.lit(NEARBY)), F.coalesce(F.left(x["hit"], F.lit(NEARBY)), F.lit("")))
    )
    return F.right(before, F.lit(NEARBY)), F.left(F.array_join(behind, ""), F.lit(NEARBY))


def _spans(kind: str, pieces: Column) -> Column:
    """Confirmed spans of one kind: array of (name, start, end, score), code points, end exclusive.

    Pieces are (gap, hit); the last is what follows the last match, its hit null.
    """
    placed = _placed(F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    low, high = SCORES[kind]
    near = rf"(?i)(?:^|[^a-z])(?:{CONTEXT[kind]})(?:$|[^a-z])"

    def score(x: Column) -> Column:
        before, after = _nearby(pieces, x["at"])
        return F.when(before.rlike(near) | after.rlike(near), F.lit(high)).otherwise(F.lit(low))

    scored = F.transform(
        F.filter(placed, lambda x: _confirmed(kind, x["hit"])),
        lambda x: F.struct(F.lit(kind).alias("name"), x["start"].alias("start"), x["end"].alias("end"), score(x).alias("score")),
    )
    kept = scored if kind in BASE_KINDS else F.filter(scored, lambda x: x["score"] >= THRESHOLD)
    return F.coalesce(kept, F.expr("CAST(array() AS ARRAY<STRUCT<name: STRING, start: INT, end: INT, score: DOUBLE>>)"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row of `docs`: array of (name, start, end, score) by kind, then start.

    Email, ip, card and phone spans are all matches that pass their check, whatever the score; iban
    and ssn need the score, which context words in the NEARBY characters before or after a span raise.

    Null text is empty, a text without personal data has an empty array. Rows are handled one by one
    without a shuffle: repeated rows, null ids and empty tables come out as they are. Columns other
    than doc_id and text are ignored. SQL expressions only.
    """
    base = docs.select("doc_id", text_of().alias("_text"))
    found = base.withColumns(
        {
            f"_{kind}": F.when(F.col("_text").rlike(NEEDLES[kind]), F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0)))
            for kind in KINDS
        }
    )
    # The text is cut at the matches: pieces between them and the matches alternate; the last has no match.
    cut = found.select(
        "doc_id",
        *(
            F.when(
                F.size(f"_{k}") > 0,
                F.arrays_zip(F.split("_text", PATTERNS[k], -1).alias("gap"), F.col(f"_{k}").alias("hit")),
            ).alias(f"_{k}")
            for k in KINDS
        ),
    )
    return cut.select("doc_id", F.concat(*(_spans(k, F.col(f"_{k}")) for k in KINDS)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """name:start:end of every span, joined by commas."""
    one = F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(one, ",")
