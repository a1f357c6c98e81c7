"""Arguments of the registered queries, shared with their SQL form."""

NOW = "2024-01-30 12:30:00"
LOW, HIGH = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
TALKER = ("10.0.0.7", "192.168.1.4")
PASSES = 3
# Events are minutes apart, so windows and steps are wider than a dashboard's minute.
WINDOW_US = 2 * 3_600_000_000
STEP_US = 3_600_000_000
STABLE_US = 4 * 3_600_000_000
BATCH_ROWS = 20
BATCH_US = 6 * 3_600_000_000
PACE_ROWS, PACE_US = 7, 6_000_000_000  # seven rows in this time, no whole microseconds apart
# Half an hour, the time a soak run takes at least.
SOAK_S = 1_800
# After the last event, so that all hours are closed.
END = "2024-02-01 00:00:00"
# Samples of the buffer this far apart belong to two episodes.
EPISODE_S = 6 * 3_600
# Limits of a run of our own.
RUN_MEMORY, RUN_DEAD_LETTERS = 64e9, 1e9
# Packets that a strict step fails on.
ODD_LENGTH, ODD_ADDRESS = 1500, "192.168.1.2"
# The normalised rank error that a sketch of 200 stays within.
RANK_ERROR = 0.017
# Pairs that the stream's summary keeps.
HEAVY_PAIRS = 200
