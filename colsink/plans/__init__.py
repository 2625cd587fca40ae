"""What a write or read will do, decided before any job starts."""
