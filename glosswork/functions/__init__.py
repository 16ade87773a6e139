"""Column functions: text, domain rules, headword and sub-entry splitting."""
