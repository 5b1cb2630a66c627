"""Two days of one invented feed, as landed.

Fifteen players of nine countries, one of which has a third of them. Two players
share a rank, names have one, two and four words, four rows have no difference,
and three players change their image from the first day to the second.
"""

HEADER = "id,rank,name,country,rating,points,lastUpdatedOn,trend,faceImageId,countryId,difference"

# Country and its id, by player.
COUNTRIES = (
    [("Norland", 41)] * 5
    + [("Sudmark", 42), ("Ostia", 43), ("Westria", 44)]
    + [("Isla Verde", 45), ("Isla Verde", 45), ("Kaltsee", 46), ("Montara", 47), ("Montara", 47)]
    + [("Rivengo", 48), ("Talamar", 49)]
)
NAMES = (
    "Ada Korhan",
    "Bram Olsten",
    "Cleo",
    "Dario Venn",
    "Esk Halvor",
    "Fenna Quist",
    "Gil Tarrow",
    "Hana Imre",
    "Ivo van der Maan",
    "Jora Pell",
    "Kito Sarn",
    "Lumi Aster",
    "Marek Dunn",
    "Nilo Vask",
    "Oona Brill",
)
RANKS = (1, 2, 3, 4, 5, 6, 7, 8, 8, 10, 11, 12, 13, 14, 15)


def _day(date: str, changed_images: frozenset[int] = frozenset()) -> list[str]:
    lines = []
    for i, (name, rank) in enumerate(zip(NAMES, RANKS)):
        country, country_id = COUNTRIES[i]
        points = 900 - 12 * rank
        trend = "Flat" if i < 4 else ("Up", "Down")[i % 2]
        difference = "" if trend == "Flat" else str({"Up": 1.0, "Down": -1.0}[trend] * (i % 3 + 1))
        image = 7000 + 10 * i + (i in changed_images)
        row = [501 + 7 * i, rank, name, country, points, points, date, trend, image, country_id]
        lines.append(",".join(map(str, [*row, difference])))
    return lines


FIRST_DAY = _day("2024-12-26")
SECOND_DAY = _day("2024-12-27", frozenset({2, 3, 13}))


def with_header(lines: list[str]) -> str:
    return "\n".join([HEADER, *lines]) + "\n"
