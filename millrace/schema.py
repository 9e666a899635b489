"""Schemas of the tables that the engine passes on."""

from __future__ import annotations

POSITION = "struct<kind string, path string, row bigint, col bigint>"
ERROR = "struct<kind string, message string, lang string>"
ENTITIES = f"lang string, source string, entity_id string, position {POSITION}, content string, error {ERROR}"
CORPUS = "lang string, source string, entity_id string, words string"

#: Kinds of errors.
IO, STRUCTURE, JSON, XML, ENCODING, LANGUAGE = "IoError", "ErroneousStructure", "JsonError", "XmlParserError", "EncodingError", "InvalidLanguageError"
