"""Table level jobs: tables in, tables out."""
