"""Readers and writers: JSON Lines, character maps, content streams, spreadsheets, dossiers, shards, settings."""
