"""recordloom.streaming"""
