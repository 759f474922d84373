"""Explicit schemas of the raw blocks and the keys of the stored families; nothing is inferred."""

from __future__ import annotations

RAW_BLOCK = """
header struct<number:bigint,hash:string,parentHash:string,timestamp:bigint,logsBloom:string,miner:string,gasUsed:string,gasLimit:string,
  baseFeePerGas:string,nonce:string,mixHash:string,stateRoot:string,receiptsRoot:string,transactionsRoot:string,sha3Uncles:string,size:bigint,
  difficulty:string,totalDifficulty:string,extraData:string>,
logs array<struct<address:string,topics:array<string>,data:string,transactionHash:string,transactionIndex:bigint,logIndex:bigint>>,
transactions array<struct<transactionIndex:bigint,hash:string,`from`:string,`to`:string,input:string,value:string,nonce:bigint,gas:string,
  gasPrice:string,maxFeePerGas:string,maxPriorityFeePerGas:string,type:int,r:string,s:string,v:string,yParity:string,
  accessList:array<struct<address:string,storageKeys:array<string>>>,
  status:string,cumulativeGasUsed:string,effectiveGasPrice:string,gasUsed:string,contractAddress:string,logsBloom:string>>,
traces array<struct<transactionIndex:bigint,traceAddress:array<int>,type:string,subtraces:int,error:string,revertReason:string,
  action:struct<`from`:string,`to`:string,value:string,gas:string,input:string,callType:string,init:string,address:string,refundAddress:string,balance:string>,
  result:struct<gasUsed:string,output:string,address:string,code:string>,
  callFrom:string,callTo:string,callValue:string,callGas:string,callInput:string,callSighash:string,callCallType:string,callResultGasUsed:string,callResultOutput:string,
  createFrom:string,createValue:string,createGas:string,createInit:string,createResultGasUsed:string,createResultCode:string,createResultAddress:string,
  suicideAddress:string,suicideRefundAddress:string,suicideBalance:string>>
""".replace("\n", " ")

#: Primary keys of the stored families.
KEYS = {
    "blocks": ["chain_id", "block_number"],
    "transactions": ["chain_id", "block_number", "transaction_index"],
    "receipts": ["chain_id", "block_number", "transaction_index"],
    "logs": ["chain_id", "block_number", "log_index"],
    "traces": ["chain_id", "block_number", "transaction_index", "trace_index"],
}
#: Columns of the families; those of a receipt are read only where a source wants them.
FAMILIES = {
    "blocks": (
        "block_number", "block_hash", "parent_hash", "block_ts", "logs_bloom", "miner", "gas_used", "gas_limit", "base_fee", "nonce", "mix_hash", "state_root",
        "receipts_root", "transactions_root", "sha3_uncles", "size", "difficulty", "total_difficulty", "extra_data",
    ),
    "logs": ("block_number", "log_index", "transaction_index", "tx_hash", "address", "topics", "data"),
    "transactions": (
        "block_number", "transaction_index", "tx_hash", "from_address", "to_address", "input", "value", "nonce", "gas", "gas_price", "max_fee_per_gas",
        "max_priority_fee_per_gas", "tx_type", "r", "s", "v", "y_parity", "access_list",
    ),
    "receipts": ("status", "cumulative_gas_used", "effective_gas_price", "gas_used", "contract_address", "logs_bloom"),
    "traces": (
        "block_number", "transaction_index", "path", "frame_type", "subtraces", "error", "revert_reason", "from_address", "to_address", "value", "gas", "gas_used", "input", "output",
    ),
}
#: Columns that a data set may lack.
NULLABLE_COLUMNS = ("access_list", "base_fee", "nonce", "mix_hash", "sha3_uncles", "total_difficulty", "revert_reason", "contract_address")
