"""corpusloom.functions"""
