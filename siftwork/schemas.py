"""Row types shared by readers, operators and sinks."""

from __future__ import annotations

CALL = "struct<id:string,type:string,function:struct<name:string,arguments:string>>"
MESSAGE = (
    f"struct<role:string,content:string,tool_calls:array<{CALL}>,tool_call_id:string,name:string>"
)
MESSAGES = f"array<{MESSAGE}>"
CHUNK = "id string, source string, text string, token_count int, ordinal int"
SIMPLE_CALL = "struct<name:string,arguments:string>"

# Replies of an external generator, as JSON strings, one type per plan kind.
QA_REPLY = f"question string, answer string, toolCalls array<{SIMPLE_CALL}>, reasoning string"
SINGLE_REPLY = (
    f"userQuery string, toolCall {SIMPLE_CALL}, toolResult string, assistantAnswer string"
)
PARALLEL_REPLY = (
    f"userQuery string, toolCalls array<{SIMPLE_CALL}>, toolResults array<string>, "
    "assistantAnswer string, dependency string"
)
MULTI_REPLY = (
    f"turns array<struct<role:string,content:string,toolCall:{SIMPLE_CALL},toolCallId:string>>"
)
REFUSAL_REPLY = "userQuery string, refusalResponse string"

EVAL_ITEM = (
    "id string, kind string, prompt string, expected string, "
    f"expectedToolCalls array<{CALL}>, sourceChunks array<string>"
)
TOOL = (
    "struct<type:string,function:struct<name:string,description:string,parameters:variant>,"
    "meta:struct<jsBody:string,requiresNetwork:boolean,"
    "trajectories:array<struct<userPrompt:string,"
    "call:struct<name:string,arguments:variant>,result:variant>>,"
    "sourceWorker:string,sourceChunks:array<string>>>"
)
