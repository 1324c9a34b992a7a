"""The small table most golden cases use."""

M_SCHEMA = "row_id long, k string, g string, x double, t double"
M_ROWS = [
    (0, "a", "u", 1.0, 10.0),
    (1, "b", "u", 2.0, 20.0),
    (2, None, "v", None, 30.0),
    (3, "a", "v", 4.0, None),
    (4, "c", None, 10.0, 50.0),
    (5, "b", "u", 2.0, 20.0),
]
