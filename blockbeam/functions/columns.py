"""Column names of the block feature table, and which of them the models use."""

from __future__ import annotations

# Column names of the block feature table (fixed values: the reference's names).
BLOCK_COLUMNS = (
    "blockId", "blockFloorTime", "numUniqueReceivers", "numTxnsInBlock", "blockFeeReward",
    "totalBtcAmountReceivedInBlock", "proportionOfReceiversWith65AccInBlock",
    "proportionOfReceiversWith70AccInBlock", "proportionOfReceiversWith75AccInBlock",
    "proportionOfReceiversWith80AccInBlock", "proportionOfReceiversWith90AccInBlock",
    "currBitcoinPrice", "bitcoinPrice1HrAgo", "bitcoinPrice2HrAgo", "bitcoinPrice3HrAgo",
    "bitcoinPrice4HrAgo", "avgAmtOfBtcPerTxn", "numTxnsWithMoreThan10Outputs", "numHighValueTxnsInBlock",
    "bitcoinPrice4HrLater", "label", "priceDiffBtw4HrLaterAndCurrPrice",
)
PRICE_CHANGES = (
    "changeInBtcPriceBtwCurrAnd1HrAgo", "changeInBtcPriceBtw1And2HrAgo",
    "changeInBtcPriceBtw2And3HrAgo", "changeInBtcPriceBtw3And4HrAgo",
)

# The models leave out keys and what is known only later; the tuner also leaves out the fee and the average amount.
_NOT_INPUT = {"blockId", "blockFloorTime", "bitcoinPrice4HrLater", "label", "priceDiffBtw4HrLaterAndCurrPrice"}
MODEL_INPUTS_V1 = [c for c in BLOCK_COLUMNS if c not in _NOT_INPUT]
MODEL_INPUTS_TUNER = [c for c in MODEL_INPUTS_V1 if c not in {"blockFeeReward", "avgAmtOfBtcPerTxn"}]
MODEL_INPUTS_V2 = [*MODEL_INPUTS_TUNER, *PRICE_CHANGES]
