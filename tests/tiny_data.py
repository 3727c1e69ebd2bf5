"""Inputs that several test modules share."""

SF_SMALL = "/root/testdata/sf0.001"

# Golden fixture "tiny" (FIXTURES.md section 3): user 4 is flat, targets include
# an unknown item (99), an unknown user (9), both, and an item rated only by the
# target user in train (5, 60).
TINY_TRAIN = [
    (1, 10, 5.0), (1, 20, 3.0), (1, 30, 1.0),
    (2, 10, 4.0), (2, 20, 2.0), (2, 40, 5.0),
    (3, 20, 5.0), (3, 30, 4.0), (3, 40, 1.0),
    (4, 10, 3.0), (4, 20, 3.0),
    (5, 50, 4.0), (5, 60, 2.0),
    (6, 10, 1.0), (6, 30, 5.0), (6, 50, 2.0),
]
TINY_TARGETS = [
    (1, 40, 4.0), (2, 30, 2.0), (3, 10, 3.0), (4, 40, 2.0), (5, 10, 5.0), (6, 20, 4.0),
    (1, 99, 3.0), (9, 10, 3.0), (9, 99, 2.0), (5, 60, 3.0),
]
SCHEMA = "user long, item long, rating double"
