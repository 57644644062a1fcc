"""Hand-made rows used by several tests."""

# Competitor id, gender, age, height, weight, repetitions.
GYM = [
    (1, "M", 23, 180, 88, 55), (2, "M", 18, 169, 84, 54), (3, "M", 25, 174, 70, 49),
    (4, "F", 24, 166, 60, 44), (5, "F", 24, 180, 78, 52), (6, "M", 25, 171, 89, 60),
    (7, "F", 18, 179, 80, 54), (8, "F", 23, 164, 70, 52), (9, "F", 21, 166, 58, 46),
    (10, "M", 20, 185, 77, 52), (11, "M", 24, 179, 81, 54), (12, "M", 19, 171, 88, 56),
    (13, "F", 22, 176, 57, 44), (14, "F", 23, 163, 65, 45), (15, "F", 23, 174, 74, 53),
    (16, "M", 25, 187, 87, 54), (17, "M", 25, 189, 84, 52), (18, "F", 20, 172, 79, 49),
    (19, "F", 21, 177, 65, 47), (20, "M", 20, 171, 70, 50),
]
GYM_SCHEMA = "CompetitorID int, Gender string, Age int, Height int, Weight int, NoOfReps int"

# Fixed values: (chapter, course), (user, chapter) and (course, title).
CHAPTERS = [(96, 1), (97, 1), (98, 1), (99, 2), *[(c, 3) for c in range(100, 110)]]
VIEWS = [(14, 96), (14, 97), (13, 96), (13, 96), (13, 96), (14, 99), (13, 100)]
TITLES = [
    (1, "How to find a better job"),
    (2, "Work faster harder smarter until you drop"),
    (3, "Content Creation is a Mug's Game"),
]


def rows(df):
    return [tuple(r) for r in df.collect()]
