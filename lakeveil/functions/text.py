"""Text form of a value, as Python's ``str()`` would print it.

Samples are matched against patterns as text, so ``123456000.0`` must not
turn into ``1.23456E8`` on the way. Everything here is a built-in expression,
written as SQL text because one string costs the driver one call where a
chain of Column methods costs dozens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# What Python's repr() escapes by name, and what it does not print.
_NAMED_ESCAPES = {9: "t", 10: "n", 13: "r"}
_NOT_PRINTED = r"r'[\p{C}\p{Z}&&[^ ]]'"
_QUOTE, _DOUBLE_QUOTE, _BACKSLASH = "char(39)", "char(34)", "char(92)"


def _quoted_sql(plain: str, escaped: str) -> str:
    """``escaped`` in single quotes, or in double ones if ``plain`` holds only single ones."""
    other = f"contains({plain}, {_QUOTE}) and not contains({plain}, {_DOUBLE_QUOTE})"
    inner = f"replace({escaped}, {_QUOTE}, concat({_BACKSLASH}, {_QUOTE}))"
    return (
        f"case when {other} then concat({_DOUBLE_QUOTE}, {escaped}, {_DOUBLE_QUOTE})"
        f" else concat({_QUOTE}, {inner}, {_QUOTE}) end"
    )


def _string_repr_sql(s: str) -> str:
    escaped = f"replace({s}, {_BACKSLASH}, concat({_BACKSLASH}, {_BACKSLASH}))"
    for code, letter in _NAMED_ESCAPES.items():
        escaped = f"replace({escaped}, char({code}), concat({_BACKSLASH}, '{letter}'))"
    digits = "lower(hex(ascii(c)))"
    code = (
        f"concat({_BACKSLASH}, case when ascii(c) < 256 then concat('x', lpad({digits}, 2, '0'))"
        f" when ascii(c) < 65536 then concat('u', lpad({digits}, 4, '0')) else concat('U', lpad({digits}, 8, '0')) end)"
    )
    each = f"array_join(transform(split({escaped}, ''), c -> case when c rlike {_NOT_PRINTED} then {code} else c end), '')"
    return _quoted_sql(s, f"case when {s} rlike {_NOT_PRINTED} then {each} else {escaped} end")


def _binary_text_sql(value: str) -> str:
    named = " ".join(
        f"when b = '{code:02X}' then concat({_BACKSLASH}, '{letter}')" for code, letter in _NAMED_ESCAPES.items()
    )
    one = (
        f"case {named} when b = '5C' then concat({_BACKSLASH}, {_BACKSLASH})"
        f" when b between '20' and '7E' then char(conv(b, 16, 10)) else concat({_BACKSLASH}, 'x', lower(b)) end"
    )
    escaped = f"array_join(transform(regexp_extract_all(hex({value}), '..', 0), b -> {one}), '')"
    # Bytes beyond ASCII don't matter for the choice of quotes.
    return f"concat('b', {_quoted_sql(f'decode({value}, {chr(39)}ISO-8859-1{chr(39)})', escaped)})"


def _moment_repr_sql(value: str) -> str:
    """Seconds are left out if they and their fraction are zero, the fraction if it is."""
    micros = f"cast(date_format({value}, 'SSSSSS') as int)"
    parts = ", ', ', ".join(f"{f}({value})" for f in ("year", "month", "day", "hour", "minute"))
    return (
        f"concat('datetime.datetime(', {parts}, case when {micros} > 0 then concat(', ', second({value}), ', ', {micros})"
        f" when second({value}) > 0 then concat(', ', second({value})) else '' end, ')')"
    )


def repr_sql(value: str, data_type: T.DataType) -> str:
    """Python's ``repr()``, the form of a value inside another; NULL stays NULL."""
    if isinstance(data_type, T.StringType):
        return _string_repr_sql(f"cast({value} as string)")
    if isinstance(data_type, T.DecimalType):
        return f"concat('Decimal(', {_QUOTE}, cast({value} as string), {_QUOTE}, ')')"
    if isinstance(data_type, T.DateType):
        return f"concat('datetime.date(', year({value}), ', ', month({value}), ', ', day({value}), ')')"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _moment_repr_sql(value)
    return repair_text_sql(raw_text_sql(value, data_type), data_type)


def _inner_sql(value: str, data_type: T.DataType) -> str:
    return f"coalesce({repr_sql(value, data_type)}, 'None')"


def _nested_text_sql(value: str, data_type: T.DataType) -> str:
    """Lists, dicts and rows. A lambda's ``x`` hides the one around it, which only its collection reads."""
    if isinstance(data_type, T.ArrayType):
        items = f"transform({value}, x -> {_inner_sql('x', data_type.elementType)})"
        text = f"concat('[', array_join({items}, ', '), ']')"
    elif isinstance(data_type, T.MapType):
        item = f"concat({_inner_sql('x.key', data_type.keyType)}, ': ', {_inner_sql('x.value', data_type.valueType)})"
        text = f"concat('{{', array_join(transform(map_entries({value}), x -> {item}), ', '), '}}')"
    else:
        fields = []
        for f in data_type.fields:
            name = f.name.replace("\\", "\\\\").replace("'", "\\'")
            inner = "`" + f.name.replace("`", "``") + "`"
            fields.append(f"concat('{name}=', {_inner_sql(f'{value}.{inner}', f.dataType)})")
        text = f"concat('Row(', concat_ws(', ', {', '.join(fields)}), ')')" if fields else "'Row()'"
    return f"case when {value} is not null then {text} end"


def raw_text_sql(value: str, data_type: T.DataType) -> str:
    """Spark's own text form, the input of ``repair_text_sql``."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # The sum turns -0.0 into 0.0, as distinct() sees it.
        return f"cast(cast({value} as double) + 0.0D as string)"
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return _nested_text_sql(value, data_type)
    if isinstance(data_type, T.BinaryType):
        return _binary_text_sql(value)
    return f"cast({value} as string)"


def _repair_float_sql(s: str) -> str:
    # Java writes 1.5E7 and 1.5E-4 where Python stays positional: go through a
    # decimal, keep one digit after the point and drop the other zeros.
    positional = f"regexp_replace(cast(try_cast({s} as decimal(38,22)) as string), r'([.][0-9]+?)0*$', '$1')"
    scientific = f"regexp_replace({s}, r'([.]0)?E-([0-9])$', 'e-0$2')"
    scientific = f"regexp_replace({scientific}, r'([.]0)?E-([0-9]+)$', 'e-$2')"
    scientific = f"regexp_replace({scientific}, r'([.]0)?E([0-9]+)$', 'e+$2')"
    return (
        f"case when not contains({s}, 'E') then"
        f" case when contains({s}, 'N') or contains({s}, 'I')"
        f" then replace(replace({s}, 'Infinity', 'inf'), 'NaN', 'nan') else {s} end"
        f" when {s} rlike r'E(-4|[7-9]|1[0-5])$' then {positional} else {scientific} end"
    )


def _repair_timestamp_sql(s: str) -> str:
    """A fraction of a second has six digits or is absent."""
    return (
        f"case when contains({s}, '.') then"
        f" concat(substring_index({s}, '.', 1), '.', rpad(substring_index({s}, '.', -1), 6, '0')) else {s} end"
    )


def repair_text_sql(s: str, data_type: T.DataType) -> str:
    """Python's text form from Spark's. Reads ``s`` several times: best given a column."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return _repair_float_sql(s)
    if isinstance(data_type, T.BooleanType):
        return f"initcap({s})"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _repair_timestamp_sql(s)
    return s


def as_text(name: str, data_type: T.DataType) -> Column:
    """Text of the column called ``name``; NULL stays NULL."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.expr(repair_text_sql(raw_text_sql(quoted, data_type), data_type))
