"""Reproducible random draws: pure functions of their key, independent of partitioning."""

from pyspark.sql import functions as F

DRAWS_PER_DIGEST = 4


def digest(key_columns, seed, block):
    """Hex digest of seed, key and block number; it holds four draws."""
    key = [c.cast("string") for c in key_columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *key, F.lit(str(block))))


def draw_from(block_digest, slot):
    """The slot-th 32-bit word of a digest as a number in [0, 1)."""
    return F.conv(F.substring(block_digest, 8 * slot + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform(key_columns, seed, draw):
    """The draw-th uniform number in [0, 1) of a row, counted from 1."""
    block, slot = divmod(draw - 1, DRAWS_PER_DIGEST)
    return draw_from(digest(key_columns, seed, block), slot)


def with_draws(df, key_columns, seed, count):
    """Add u1..u<count>. Digests and draws are columns of their own, so each is computed once per row."""
    blocks = range((count + DRAWS_PER_DIGEST - 1) // DRAWS_PER_DIGEST)
    hashed = df.withColumns({f"_digest{b}": digest(key_columns, seed, b) for b in blocks})
    drawn = hashed.withColumns({
        f"u{i + 1}": draw_from(F.col(f"_digest{i // DRAWS_PER_DIGEST}"), i % DRAWS_PER_DIGEST) for i in range(count)})
    return drawn.drop(*[f"_digest{b}" for b in blocks])


def row_digest(columns, seed):
    """Hex digest that orders rows pseudo-randomly; equal rows get equal digests."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *shown))
