"""IP addresses as canonical text, in plain SQL expressions (no Python workers)."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, functions as F

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_V4_ONLY = rf"^{_V4}\z"
_V4_TAIL = rf"^(.*:)({_V4})\z"
_EIGHT_GROUPS = r"^(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}\z"


def _group(high: int, low: int) -> str:
    return f"lower(hex(int(o[{high}]) * 256 + int(o[{low}])))"


def _groups_in(part: str) -> str:
    return f"if({part} = '', 0, length({part}) - length(replace({part}, ':', '')) + 1)"


def _bytes(i: int) -> str:
    return f"int(conv(g[{i}], 16, 10)) div 256, '.', int(conv(g[{i}], 16, 10)) % 256"


# Each step maps the text v to the next one; NULL stays NULL.
# A dotted tail becomes two hexadecimal groups.
_HEX_TAIL = rf"""CASE WHEN contains(v, '.') AND v RLIKE r'{_V4_TAIL}'
  THEN transform(array(split(regexp_extract(v, r'{_V4_TAIL}', 2), r'\.')),
    o -> concat(regexp_extract(v, r'{_V4_TAIL}', 1), {_group(0, 1)}, ':', {_group(2, 3)}))[0]
  ELSE v END"""

# "::" is written out; it stands for one group at least and occurs once.
_MISSING = f"(8 - {_groups_in('p.l')} - {_groups_in('p.r')})"
_EXPANDED = f"""CASE WHEN contains(v, '::')
  THEN transform(array(named_struct('l', substring_index(v, '::', 1), 'r', substring_index(v, '::', -1))),
    p -> CASE WHEN {_MISSING} >= 1 AND length(v) = length(p.l) + length(p.r) + 2
      THEN concat_ws(':', nullif(p.l, ''), array_repeat('0', {_MISSING}), nullif(p.r, '')) END)[0]
  ELSE v END"""

_CHECKED = f"CASE WHEN v RLIKE r'{_EIGHT_GROUPS}' THEN v END"

_NO_LEADING_ZEROS = """CASE WHEN v RLIKE r'(?:^|:)0[0-9a-f]'
  THEN regexp_replace(v, r'(^|:)0{1,3}([0-9a-f])', '$1$2') ELSE v END"""

# Runs of zeros are all made of "0:", so the greatest text is the longest run; its first place
# behind a colon is where the first run of that length starts.
_COMPRESSED = f"""CASE WHEN startswith(v, '0:0:0:0:0:ffff:')
  THEN transform(array(split(v, ':')), g -> concat('::ffff:', {_bytes(6)}, '.', {_bytes(7)}))[0]
  ELSE transform(array(named_struct('all', concat(':', v, ':'),
      'run', array_max(regexp_extract_all(concat(':', v, ':'), r'(?<=:)(?:0:)+', 0)))),
    z -> CASE WHEN length(z.run) > 2
      THEN concat(substring(z.all, 2, greatest(instr(z.all, concat(':', z.run)) - 2, 0)), '::',
        rtrim(':', substring(z.all, instr(z.all, concat(':', z.run)) + length(z.run) + 1)))
      ELSE v END)[0] END"""


def _chained(text: str) -> str:
    chain = f"array(lower({text}))"
    for step in (_HEX_TAIL, _EXPANDED, _CHECKED, _NO_LEADING_ZEROS, _COMPRESSED):
        chain = f"transform({chain}, v -> {step})"
    return f"{chain}[0]"


def ip_canonical_sql(text: str) -> str:
    """SQL for the canonical form of the address in column ``text``, NULL if it is none.

    IPv4 octets take no leading zeros. IPv6 follows the usual short form: the longest run of
    two or more zero groups, the first of equals, becomes ``::``; IPv4-mapped addresses keep
    the dotted tail. Zone ids are refused, as an address column cannot hold them.
    Only text that holds a colon reaches the IPv6 steps.
    """
    return (
        f"CASE WHEN {text} RLIKE r'{_V4_ONLY}' THEN {text} "
        f"WHEN contains({text}, ':') THEN {_chained(text)} END"
    )


def ip_canonical(text: str) -> Column:
    return F.expr(ip_canonical_sql(text))


def ip_version(address: str) -> Column:
    return F.expr(f"CASE WHEN contains({address}, ':') THEN 6 ELSE 4 END")


def canonical_address(text: str) -> str:
    """An address in the form it is stored in; other text stays as it is."""
    try:
        return str(ipaddress.ip_address(text))
    except ValueError:
        return text
