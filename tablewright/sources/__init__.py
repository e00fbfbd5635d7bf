"""Where DataFrames come from: tables, text files, frames, file trees, versions."""
