"""Protection of columns: reversible tokens, one-way tokens, generalised places.

Reversible tokens use AES-CBC with an initial vector derived from the key and
the value (a synthetic vector), so equal values give equal tokens and joins and ``distinct`` keep
working. The vector is also the integrity check: a token opens only if its clear text
gives the vector that it carries. Keys come from the session settings or the caller and are never written
here; set ``spark.sql.redaction.string.regex`` to hide them in plan texts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_PREFIX = "spark.feedweave.key."
VECTOR_BYTES = 16


def base64_line(c: Column) -> Column:
    """Base64 on one line: Spark breaks its Base64 text after 76 characters, by carriage return and line feed."""
    return F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))


@dataclass(frozen=True)
class KeyRing:
    """Hexadecimal AES keys (16, 24 or 32 bytes) by key id."""

    keys: Mapping[str, str] = field(repr=False)

    @classmethod
    def from_session(cls, spark: SparkSession, *key_ids: str) -> KeyRing:
        return cls({k: spark.conf.get(KEY_PREFIX + k) for k in key_ids})

    def protect(self, c: Column, key_id: str) -> Column:
        """Deterministic reversible token, Base64. Null stays null."""
        text = c.cast("string")
        key = F.unhex(F.lit(self.keys[key_id]))
        return base64_line(F.aes_encrypt(text, key, F.lit("CBC"), F.lit("PKCS"), self._vector(text, key_id)))

    def _vector(self, text: Column, key_id: str) -> Column:
        return F.unhex(F.substring(F.sha2(F.concat(F.lit(self.keys[key_id]), F.lit("|"), text), 256), 1, 2 * VECTOR_BYTES))

    def unprotect(self, c: Column, key_id: str) -> Column:
        """Clear text of a token; null for null, for text that is no token of this key, and for an altered token."""
        raw = F.try_to_binary(c, F.lit("base64"))
        clear = F.try_aes_decrypt(raw, F.unhex(F.lit(self.keys[key_id])), F.lit("CBC"), F.lit("PKCS")).cast("string")
        # both uses of the clear text are always evaluated, so that Spark decrypts once
        return F.concat(clear, F.when(self._vector(clear, key_id) == F.substring(raw, 1, VECTOR_BYTES), F.lit("")))

    def reprotect(self, c: Column, from_key: str, to_key: str) -> Column:
        """Swap the key of a token inside one expression: clear text is never stored."""
        return self.protect(self.unprotect(c, from_key), to_key)


def tokenise(c: Column, salt: str) -> Column:
    """One-way token: SHA-256 of salt and value."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def encode_base64(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: base64_line(F.col(c).cast("string").cast("binary")) for c in columns})


def publish_token(df: DataFrame, column: str, token: Column) -> DataFrame:
    """Replace ``column`` by its Base64-encoded token and drop rows that became equal."""
    return df.withColumn(column, base64_line(token.cast("binary"))).distinct()


def zip_prefix(clear_zip: Column, pad_first: bool = False) -> Column:
    text = F.rpad(clear_zip, 5, " ") if pad_first else clear_zip
    return F.substring(text, 1, 3)


def zip3_generalise(stored: Column, clear_zip: Column, suppressed: Column, pad_first: bool = False) -> Column:
    """Three digits and '00'; '00000' on the suppress list; spaces for null."""
    return (
        F.when(F.trim(stored).isNull(), F.lit("     "))
        .when(suppressed, F.lit("00000"))
        .otherwise(F.concat(zip_prefix(clear_zip, pad_first), F.lit("00")))
    )
