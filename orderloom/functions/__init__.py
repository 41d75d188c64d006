"""Column expressions: text, money, time, JSON values and fingerprints."""
