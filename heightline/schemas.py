"""Schemas, built without a session."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, BINARY = T.StringType(), T.LongType(), T.IntegerType(), T.BinaryType()
UINT64 = T.DecimalType(20, 0)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Wire names and types of a block.
HEADER = struct(
    parentHash=STRING,
    uncleHash=STRING,
    coinbase=STRING,
    root=STRING,
    txHash=STRING,
    receiptHash=STRING,
    bloom=STRING,
    difficulty=STRING,
    number=UINT64,
    gasLimit=UINT64,
    gasUsed=UINT64,
    time=UINT64,
    extra=STRING,
    mixDigest=STRING,
    nonce=STRING,
    baseFee=STRING,
    withdrawalsHash=STRING,
    parentBeaconRoot=STRING,
    blobGasUsed=UINT64,
    excessBlobGas=UINT64,
)
ACCESS = struct(address=STRING, storageKeys=T.ArrayType(STRING))
TRANSACTION = struct(
    hash=STRING,
    type=INT,
    to=STRING,
    value=STRING,
    gas=UINT64,
    gasPrice=STRING,
    maxFeePerGas=STRING,
    maxPriorityFeePerGas=STRING,
    nonce=UINT64,
    data=STRING,
    accessList=T.ArrayType(ACCESS),
    chainId=STRING,
)
WITHDRAWAL = struct(index=UINT64, validator=UINT64, address=STRING, amount=UINT64)
BLOCK = struct(
    hash=STRING,
    header=HEADER,
    uncles=T.ArrayType(HEADER),
    transactions=T.ArrayType(TRANSACTION),
    withdrawals=T.ArrayType(WITHDRAWAL),
)

OUTBOX = struct(id=STRING, hash=STRING, number=STRING, payload=STRING, scanned_at_ms=STRING)
RECORD = struct(
    topic=STRING,
    key=BINARY,
    value=BINARY,
    headers=T.ArrayType(struct(key=STRING, value=BINARY)),
    hash=STRING,
)
LEDGER = struct(hash=STRING, published_at=LONG)
QUARANTINE = struct(id=STRING, hash=STRING, number=STRING, payload=STRING, reason=STRING)
