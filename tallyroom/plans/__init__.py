"""End-to-end analyses, one module per kind of data. Frames in, frames out."""
