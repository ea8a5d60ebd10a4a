"""Column functions: text cleaning, places, dates, predicates and skills."""
