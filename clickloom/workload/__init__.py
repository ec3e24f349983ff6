"""The operators applied to the given ``events`` table, with matching SQL."""
