"""Reading listens, dimension dumps, recommendation files, reports and logs; writing results."""
